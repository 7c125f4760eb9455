"""Streaming forms of cross-run de-duplication and of the delta sync."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.functions.text import canonical_text, dedup_hash


def unique_questions(stream: DataFrame, text: str, event_time: str, keep: str = "1 day") -> DataFrame:
    """The first question of each hash; a hash is forgotten once the watermark has passed it by ``keep``."""
    hashed = stream.withColumn("hash", dedup_hash(canonical_text(F.col(text)))).where("hash IS NOT NULL")
    return hashed.withWatermark(event_time, keep).dropDuplicatesWithinWatermark(["hash"])


def windowed_counts(stream: DataFrame, event_time: str, by: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Questions in each event-time window; rows later than ``late`` do not count."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, window), by).agg(F.count("*").alias("n"))


def sync_batches(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: appends the rows of a batch whose key the table lacks, so a replayed batch adds nothing."""
    from quizloom.sources.bank import append_new

    def write(batch: DataFrame, _: int) -> None:
        append_new(batch, path, key)

    return write


def store_batches(path: str, key: str, name: str = "stream", order: str | None = None, add_only: bool = False) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: rows take the place of those with their keys in the keyed table at ``path``, or are added if their keys are new; each batch of ``name`` makes one version and counts once."""
    from quizloom.sources.store import Store

    def write(batch: DataFrame, number: int) -> None:
        store = Store.open(batch.sparkSession, path, batch.schema, key)
        change = store.insert if add_only else store.upsert
        change(batch, order, batch=(name, number))

    return write


def unseen_batches(path: str, out: str, key: str = "hash", kind: str = "string") -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the rows whose key neither an earlier run nor an earlier batch has go to the keyed table ``out``, and their keys to the state at ``path``.

    The table is written first: a batch that is played again finds its own rows there, and adds what the state lacks.
    """
    from quizloom.sources.seen import SeenState
    from quizloom.sources.store import Store

    def write(batch: DataFrame, number: int) -> None:
        state = SeenState(batch.sparkSession, path, key, kind)
        Store.open(batch.sparkSession, out, batch.schema, key).insert(state.unseen(batch), batch=(out, number))
        state.add(batch, batch=(out, number))

    return write
