"""Periodic runs of words by block matching.

A run of period q, at least 4q words long, holds an aligned block of B words, B the power of two with B <= q < 2B, that stands
again q words further on. So for each B all aligned blocks become integer-sequence keys of an Aho-Corasick automaton that searches the words;
an occurrence that starts B to 2B - 1 words behind the block it repeats is a seed, and comparing words q apart to both sides of a seed gives
the maximal stretch. Of the periods of one stretch the smallest counts; multiples of it are met later and passed over.

Every word of a run stands four times in it, so the search is made in the stretches that such words leave.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import small_batches, thrifty

#: Words and periods that a run holds at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Rounds of narrowing before the search; more only save time.
ROUNDS = 8
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
Run = tuple[int, int, int]


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches outside which no run has a word: each word stands four times in its stretch."""
    todo, out = [(0, len(ids), 0)], []
    while todo:
        a, b, n = todo.pop()
        if b - a < LEAST_WORDS:
            continue
        _, place, count = np.unique(ids[a:b], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(count[place] < LEAST_PERIODS)
        if not len(rare) or n == ROUNDS:
            out.append((a, b))
            continue
        ends = np.append(rare, b - a) + a
        starts = np.append(a, ends[:-1] + 1)
        todo += [(int(x), int(y), n + 1) for x, y in zip(starts, ends, strict=True) if y - x >= LEAST_WORDS]
    return out


def same_up(w: np.ndarray, a: int, b: int) -> int:
    """How many words from a on equal those from b on, a < b."""
    n, size, room = 0, 32, len(w) - b
    while n < room:
        k = min(size, room - n)
        other = np.flatnonzero(w[a + n : a + n + k] != w[b + n : b + n + k])
        if len(other):
            return n + int(other[0])
        n, size = n + k, 2 * size
    return n


def same_down(w: np.ndarray, a: int, b: int) -> int:
    """How many words before a equal those before b, a < b."""
    n, size = 0, 32
    while n < a:
        k = min(size, a - n)
        other = np.flatnonzero(w[a - n - k : a - n] != w[b - n - k : b - n])
        if len(other):
            return n + k - 1 - int(other[-1])
        n, size = n + k, 2 * size
    return n


def seeds(words: list[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts of aligned blocks, starts of their repeats size to 2 * size - 1 words on), found by the automaton of all aligned blocks."""
    automaton, number = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE), {}
    own = np.empty(len(words) // size, np.int64)
    for k in range(len(own)):
        block = tuple(words[k * size : (k + 1) * size])
        own[k] = n = number.setdefault(block, len(number))
        if n == len(number) - 1:
            automaton.add_word(block, n)
    automaton.make_automaton()
    hits = np.fromiter(chain.from_iterable(automaton.iter(tuple(words))), np.int64).reshape(-1, 2)
    at = hits[:, 0] - size + 1
    block = at // size - 1  # the only aligned block at such a distance
    good = block >= 0
    good[good] = own[block[good]] == hits[good, 1]
    return block[good] * size, at[good]


def runs_within(w: np.ndarray) -> list[Run]:
    """Runs (start, length, period) of a stretch."""
    words, found, size = w.tolist(), {}, 1
    period, end = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)  # of a run that covers a word
    while LEAST_PERIODS * size <= len(w):
        s, t = seeds(words, size)
        q = t - s
        fresh = (period[s] == 0) | (q % np.maximum(period[s], 1) != 0) | (end[s] < t + size)  # else within a run of a divisor of q
        s, t, q = s[fresh], t[fresh], q[fresh]
        last = (0, 0)  # period and end of the stretch compared last
        for k in np.lexsort((s, q)):
            a, b, d = int(s[k]), int(t[k]), int(q[k])
            if last[0] == d and b + size <= last[1]:
                continue
            i, j = a - same_down(w, a, b), b + size + same_up(w, a + size, b + size)
            last = (d, j)
            if j - i >= max(LEAST_WORDS, LEAST_PERIODS * d) and (i, j) not in found:
                found[i, j] = d
                free = period[i:j] == 0
                period[i:j][free], end[i:j][free] = d, j
        size *= 2
    return [(i, j - i, d) for (i, j), d in found.items()]


def runs_of(words: list[bytes]) -> list[Run]:
    """All runs (start, length, period) of a text's words, by start, then period."""
    if len(words) < LEAST_WORDS:
        return []
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    return sorted(((a + s, n, q) for a, b in stretches(ids) for s, n, q in runs_within(ids[a:b])), key=lambda r: (r[0], r[2]))


def kept(n: int, runs: list[Run]) -> np.ndarray:
    """Whether each of n words stays: of a run only its first period does."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", prepare: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """Add n_words, runs (array of start, length, period, by start, then period) and collapsed (the kept words, joined by one space) to each row; the text column goes.

    Words are runs of anything but ASCII white space, numbered from 0. A run is a stretch with smallest period q of max(6, 4q) words or more that no
    neighbouring word extends with that period; a word is dropped if a run contains it behind that run's first q words. ``prepare`` (words, key) may change the words first.
    A null or empty text has no words, no runs and an empty ``collapsed``. Rows stand for themselves: keys may be null or repeated, equal texts give equal rows,
    an empty table none. Columns with the names of added ones are replaced. A text is searched whole, in memory in proportion to its words.
    """
    small_batches(docs.sparkSession)
    added = ("n_words", "runs", "collapsed")
    rest = [c for c in docs.columns if c != text and c not in added]
    source = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias("__text"), F.col(f"`{key}`").alias("__key"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            sizes, found, left = [], [], []
            for t, k in zip(batch.column("__text").to_pylist(), batch.column("__key").to_pylist(), strict=True):
                words = (t or "").encode().split()
                words = prepare(words, k) if prepare else words
                runs = runs_of(words)
                if runs:
                    words_left = [words[i] for i in np.flatnonzero(kept(len(words), runs))]
                sizes.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                left.append(b" ".join(words_left if runs else words).decode())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(sizes, pa.int64()), pa.array(found, run_type), pa.array(left, pa.string())], [*rest, *added])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-2]] + ["n_words bigint", f"runs {RUNS}", "collapsed string"]
    return source.mapInArrow(thrifty(run), ", ".join(fields))
