"""Calls to models of text, vectors and images, as Arrow batches between two written tables.

Requests are written with an id of their content before any call, responses after; with a journal that outlives
the session, a request that has a response is not sent again. The default provider answers from a hash, offline. Real ones are given as callables; their keys come
from the executors' own environment.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.functions.jsonfix import DETAILS_MARK, QUESTION_MARK
from quizloom.functions.prompts import for_provider
from quizloom.sources.journal import Journal


@dataclass(frozen=True)
class Provider:
    """What a provider is called with, and how. ``knobs`` are the settings it honours."""

    name: str
    knobs: tuple[str, ...] = ()
    named: bool = False  # its system prompt starts with the model's name
    fixed: tuple[tuple[str, int], ...] = ()


# The providers and the settings each one honours
PROVIDERS = {p.name: p for p in (
    Provider("openai", ("temperature", "top_p", "presence_penalty", "frequency_penalty")),
    Provider("gemini", (), True),
    Provider("deepseek", ("temperature", "top_p"), False, (("max_tokens", 1000), ("timeout", 30))),
    Provider("anthropic", ("temperature",), True, (("max_tokens", 8000),)),
    Provider("grok", ("temperature", "top_p", "seed")),
)}
Call = Callable[[str, str, str, dict], str | None]


def offline(provider: str, system_prompt: str, user_prompt: str, settings: dict) -> str:
    """A fenced list of questions that depends on the prompts only; ``num_questions`` of them, if that is set."""
    h = hashlib.sha256(f"{provider}|{system_prompt}|{user_prompt}".encode()).hexdigest()
    made = []
    for i in range(int(settings.get("num_questions", 2))):
        own = hashlib.sha256(f"{h}|{i}".encode()).hexdigest()
        made.append({"question": f"Which value has code {own[:8]}?", "multiple_choices": [f"{c}. {own[8 + 4 * k:12 + 4 * k]}" for k, c in enumerate("ABCD")], "correct_answer": "ABCD"[int(own[-1], 16) % 4], "level": "Applying", "level_num": 3, "requires_diagram": int(own[-2], 16) < 6})
    return "```json\n" + json.dumps({"questions": made}) + "\n```"


def requests(rows: DataFrame, provider: str = "offline", system: str = "system_prompt", user: str = "user_prompt", model: str = "offline", settings: dict | None = None, per_row: tuple[str, ...] = ()) -> DataFrame:
    """Adds settings (JSON) and request_id, a hash of all that the answer may depend on; an unknown provider is an error before anything runs.

    Columns named in ``per_row`` are settings of their row. Settings that the provider does not honour are left out; the offline one honours all.
    """
    if provider not in PROVIDERS and provider != "offline":
        raise ValueError(f"no such provider: {provider!r}")
    known = PROVIDERS.get(provider)
    wanted = {k: F.lit(v) for k, v in (settings or {}).items()} | {k: F.col(k) for k in per_row}
    told = {k: v for k, v in wanted.items() if known is None or k in known.knobs} | {k: F.lit(v) for k, v in (known.fixed if known else ())}
    named = tuple(p.name for p in PROVIDERS.values() if p.named)
    out = rows.withColumn(system, for_provider(F.col(system), F.lit(provider), F.lit(model), named))
    out = out.withColumn("settings", F.to_json(F.struct(*[told[k].alias(k) for k in sorted(told)])) if told else F.lit("{}"))
    return out.withColumn("request_id", F.sha2(F.concat_ws("\n", F.lit(provider), F.lit(model), "settings", F.col(system), F.col(user)), 256))


def respond(todo: DataFrame, provider: str = "offline", call: Call = offline, system: str = "system_prompt", user: str = "user_prompt", connect: Callable[[], Call] | None = None, tasks: int | None = None) -> DataFrame:
    """request_id, response for each distinct request; null where the call fails. Write the result before using it: every evaluation calls.

    ``connect`` is called once in each of the ``tasks`` partitions (as many as the cluster has cores, if not given) and returns what calls; without it ``call`` does.
    """

    def run(batches):
        asking = connect() if connect else call
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    out.append(asking(provider, row[system], row[user], json.loads(row["settings"])))
                except Exception:  # noqa: BLE001  whatever a client raises, the row has no answer
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("request_id"), pa.array(out, pa.string())], ["request_id", "response"])

    asked = todo.select("request_id", system, user, "settings").dropDuplicates(["request_id"])
    # a given number of partitions, as adaptive execution would put short requests into one task and make all calls wait for each other
    return asked.repartition(tasks or todo.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "request_id string, response string")


def answers(todo: DataFrame, path: str, per_batch: int = 1000, system: str = "system_prompt", user: str = "user_prompt", tasks: int | None = None, **options) -> DataFrame:
    """request_id, response of all requests that have one in the journal at ``path``, through which those of new requests go first, some ``per_batch`` at stake at a time.

    A request that has a response is not sent again, in this run or a later one; failed ones are, and after a run that broke off those its tasks were at.
    """
    asked = todo.select("request_id", system, user, "settings")
    return Journal(todo.sparkSession, path, "request_id string, response string").run(asked, lambda rows, parts: respond(rows, system=system, user=user, tasks=parts, **options), per_batch, tasks)


def offline_reading(provider: str, prompt: str, content: bytes) -> str:
    """What a model might say of an image, by the bytes only."""
    return f"{QUESTION_MARK} What does image {hashlib.sha256(content).hexdigest()[:8]} show?\n---\n{DETAILS_MARK} {len(content)} bytes"


def image_requests(images: DataFrame, content: str, prompt: str, provider: str = "offline", model: str = "offline") -> DataFrame:
    """Adds request_id, a hash of the image's digest and of all else that the answer may depend on; images without content go."""
    return images.where(F.col(content).isNotNull()).withColumn("request_id", F.sha2(F.concat_ws("\n", F.lit(provider), F.lit(model), F.lit(prompt), F.sha2(F.col(content), 256)), 256))


def read_images(todo: DataFrame, content: str, prompt: str, provider: str = "offline", call: Callable[[str, str, bytes], str | None] = offline_reading, connect: Callable[[], Callable[[str, str, bytes], str | None]] | None = None, tasks: int | None = None) -> DataFrame:
    """request_id, response: text for each distinct image; null where the call fails. Written before use, as ``respond``; ``connect`` and ``tasks`` are as there."""

    def run(batches):
        asking = connect() if connect else call
        for batch in batches:
            out = []
            for image in batch.column(1).to_pylist():
                try:
                    out.append(asking(provider, prompt, image))
                except Exception:  # noqa: BLE001  whatever a client raises, the row has no answer
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("request_id"), pa.array(out, pa.string())], ["request_id", "response"])

    asked = todo.select("request_id", content).dropDuplicates(["request_id"])
    return asked.repartition(tasks or todo.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "request_id string, response string")


def hash_vector(text: str, size: int = 16) -> list[float]:
    """A unit vector that depends on the text only, for offline use."""
    raw = b"".join(hashlib.sha256(f"{i}|{text}".encode()).digest() for i in range(-(-size * 4 // 32)))
    v = [x / 2**31 - 1 for x in struct.unpack(f"<{size}I", raw[: 4 * size])]
    norm = sum(x * x for x in v) ** 0.5 or 1.0
    return [x / norm for x in v]


def embed(rows: DataFrame, key: str, document: str, vector: Callable[[str], list[float]] = hash_vector, connect: Callable[[], Callable] | None = None, vectors: Callable[[list[str]], list[list[float]]] | None = None, batched: bool = False, batch_rows: int = 64, batch_letters: int = 65_536) -> DataFrame:
    """key, embedding (array<float>); null documents have none, and neither have those for which the model fails.

    ``vector`` makes one vector a call; ``vectors`` gets a list of texts, of like length, at most ``batch_rows`` of them, and no more than ``batch_letters`` if each were as long as the longest. A list that
    fails is asked text by text. ``connect`` is called once a partition and returns what makes vectors, of lists if ``batched``.
    """
    whole = vectors is not None or batched

    def run(batches):
        make = connect() if connect else vectors or vector
        ask = make if whole else lambda texts: [make(t) for t in texts]

        def alone(text):
            try:
                return ask([text])[0]
            except Exception:  # noqa: BLE001  whatever a model raises, the row has no vector
                return None

        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = [None] * len(texts)
            for some in by_length(texts, batch_rows, batch_letters):
                try:
                    made = list(ask([texts[k] for k in some]))
                    if len(made) != len(some):
                        raise ValueError(f"{len(made)} vectors for {len(some)} texts")
                except Exception:  # noqa: BLE001
                    made = [alone(texts[k]) for k in some]
                for k, v in zip(some, made, strict=True):
                    out[k] = v
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float32()))], [key, "embedding"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, document).mapInArrow(run, f"`{key}` {kind}, embedding array<float>")


def by_length(texts: list[str | None], most_rows: int, most_letters: int) -> list[list[int]]:
    """Places of the texts in lists for one call each, longest first; a text over the bound is alone, nulls are in none."""
    out: list[list[int]] = []
    for k in sorted((k for k, t in enumerate(texts) if t is not None), key=lambda k: -len(texts[k])):
        if not out or len(out[-1]) == most_rows or (len(out[-1]) + 1) * len(texts[out[-1][0]]) > most_letters:
            out.append([])
        out[-1].append(k)
    return out


def images(rows: DataFrame, key: str, prompt: str, draw: Callable[[str | bytes], bytes | None] | None = None, connect: Callable[[], Callable[[str | bytes], bytes | None]] | None = None) -> DataFrame:
    """key, content (PNG bytes or null) for each prompt, which may be the bytes of an image to be drawn anew; molecules are drawn by the same form, from SMILES or a name. ``connect`` is called once a partition and returns what draws."""

    def run(batches):
        make = connect() if connect else draw
        for batch in batches:
            out = []
            for p in batch.column(1).to_pylist():
                try:
                    out.append(make(p))
                except Exception:  # noqa: BLE001
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [key, "content"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, prompt).mapInArrow(run, f"`{key}` {kind}, content binary")


def draw_molecule(name_or_smiles: str, lookup: Callable[[str], str | None] | None = None) -> bytes | None:
    """PNG of a structure from SMILES, else from the SMILES that ``lookup`` has for a name, else none; needs the optional chemistry package."""
    import io

    from rdkit import Chem
    from rdkit.Chem import Draw

    mol = Chem.MolFromSmiles(name_or_smiles)
    if mol is None and lookup and (found := lookup(name_or_smiles)):
        mol = Chem.MolFromSmiles(found)
    if mol is None:
        return None
    out = io.BytesIO()
    Draw.MolToImage(mol, size=(300, 300)).save(out, "PNG")
    return out.getvalue()
