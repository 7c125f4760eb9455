"""BPE encoding and decoding by speculation and verification.

A greedy longest match proposes the tokens of a pre-token. A proposal is the BPE encoding exactly if no merge
would have crossed a boundary between two neighbours; that test runs over all adjacent pairs of all new pre-tokens
of a batch at once, in numpy. Only the pre-tokens with a failing pair go through exact merging.

The vocabulary is a ``tokenizers`` JSON file with a BPE model that marks word ends; its normaliser and
pre-tokeniser are followed exactly (texts of Latin letters take a quick way that gives the same pieces).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections import Counter
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import small_batches, thrifty

#: Pre-tokens a worker remembers, and their characters, in two halves: when either number is reached, the half not used of late is forgotten.
REMEMBERED, REMEMBERED_LETTERS = 300_000, 4_000_000
#: Symbols of the longest pre-tokens that are merged together in numpy; longer ones are merged one by one.
TOGETHER = 64
#: Characters of one text that are taken at a time.
CHUNK = 1 << 20
NEVER = np.int64(1) << 40


def byte_letters() -> str:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(rest)) for b in range(256))


class WordBpe:
    """One vocabulary file; ``encode_many`` turns pre-tokens into packed little-endian ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = self.vocab | special
        self.size = max(names.values()) + 1
        self.names = [""] * self.size
        for name, i in names.items():
            self.names[i] = name
        self.longest = max(map(len, self.vocab))
        self.letters = byte_letters()
        self.byte_of = {c: i for i, c in enumerate(self.letters)}
        self.spaced = [f" {n}".encode() for n in self.names]
        self._merges(model["merges"])
        library = Tokenizer.from_file(path)
        self.normaliser, self.splitter = library.normalizer, library.pre_tokenizer
        self.special = {s: i.to_bytes(4, "little") for s, i in special.items()}
        self.special_at = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        letters = "".join(chr(c) for c in range(0x180) if chr(c).isalpha())
        # numbers among these: decimal digits, superscripts and fractions; white space as Unicode has it
        digits, space = "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
        self.quick = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{space}{letters}{digits}]+")
        self.odd = re.compile("[^\x00-įı-ſ]")  # U+0130 lower-cases to two characters
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = dict(self.special)
        self.older: dict[str, bytes] = {}
        self.letters_known = 0

    def _merges(self, merges: list) -> None:
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        self.left, self.right = np.zeros((2, self.size), np.int64)
        self.made = np.full(self.size, -1, np.int64)  # the rank that makes a token; -1: a single symbol
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.rank[x, y] = rank, z
            if self.made[z] < 0:
                self.left[z], self.right[z], self.made[z] = x, y, rank
        keys = np.array([x * self.size + y for x, y in self.rank], np.int64)
        ranks = np.array([r for r, _ in self.rank.values()], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], ranks[order], np.array([z for _, z in self.rank.values()], np.int64)[order]
        self.inner, self.last = (np.array([self.vocab.get(c + end, -1) for c in self.letters], np.int64) for end in ("", self.suffix))
        # a token is proposed only if merging its own symbols gives it back
        made = np.flatnonzero(self.made >= 0)
        sound = np.ones(self.size, bool)
        sound[made] = self.compatible(self.left[made], self.right[made], self.made[made])
        for z in made[np.argsort(self.made[made])]:
            sound[z] &= sound[self.left[z]] and sound[self.right[z]]
        self.proposable = {n: i for n, i in self.vocab.items() if sound[i]}

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge (of a rank below ``limit``) crosses the boundary between tokens a and b.

        Goes back through the merges that made both tokens, latest first. The symbols x and y at the boundary stand
        side by side until one is merged away, at rank px or py; their own merge comes first if its rank is less
        than px and at most py, as equal ranks go from left to right.
        """
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = np.array(a, np.int64), np.array(b, np.int64)
        px = np.full(len(x), NEVER) if limit is None else np.array(limit, np.int64)
        py = px - (limit is not None)
        while len(at):
            key = x * self.size + y
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            crossed = (self.keys[i] == key) & (self.ranks[i] < px) & (self.ranks[i] <= py)
            ok[at[crossed]] = False
            mx, my = self.made[x], self.made[y]
            go = ~crossed & ((mx >= 0) | (my >= 0))
            back = mx > my
            px, py = np.where(back, mx, px)[go], np.where(back, py, my)[go]
            x, y, at = np.where(back, self.right[x], x)[go], np.where(back, y, self.left[y])[go], at[go]
        return ok

    def propose(self, word: str) -> list[int]:
        """Greedy longest match of byte letters; -1 if it gets stuck."""
        out, at, n, known = [], 0, len(word), self.proposable
        while at < n:
            if n - at <= self.longest and (i := known.get(word[at:] + self.suffix)) is not None:
                out.append(i)
                break
            for to in range(min(n - 1, at + self.longest), at, -1):
                if (i := known.get(word[at:to])) is not None:
                    break
            else:
                return [-1]
            out.append(i)
            at = to
        return out

    def merge(self, word: str) -> list[int]:
        """Exact merging, lowest rank first and from left to right. Symbols outside the vocabulary go, as there is no unknown token."""
        ids = [i for c in word[:-1] if (i := self.vocab.get(c)) is not None]
        if (i := self.vocab.get(word[-1] + self.suffix)) is not None:
            ids.append(i)
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(*self.rank[p], k) for k in range(n - 1) if (p := (ids[k], ids[k + 1])) in self.rank]
        heap = [(r, k, z) for r, z, k in heap]
        heapq.heapify(heap)
        while heap:
            r, k, z = heapq.heappop(heap)
            if ids[k] < 0 or (m := after[k]) < 0 or self.rank.get((ids[k], ids[m])) != (r, z):
                continue
            ids[k], ids[m], after[k] = z, -1, after[m]
            if after[k] >= 0:
                before[after[k]] = k
                if found := self.rank.get((z, ids[after[k]])):
                    heapq.heappush(heap, (found[0], k, found[1]))
            if (j := before[k]) >= 0 and (found := self.rank.get((ids[j], z))):
                heapq.heappush(heap, (found[0], j, found[1]))
        return [i for i in ids if i >= 0]

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` for many words at once: in each round every word's pair of lowest rank, the first of them, becomes one symbol. Words of more than TOGETHER bytes, or with bytes outside the vocabulary, go one by one."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        symbols = self.inner[flat]
        symbols[ends - 1] = self.last[flat[ends - 1]]
        unknown = np.add.reduceat(symbols < 0, ends - sizes) > 0
        out: list[list[int]] = [[]] * len(words)
        alone = unknown | (sizes > TOGETHER)
        for k in np.flatnonzero(alone):
            out[k] = self.merge(words[k].decode("latin-1").translate(self.letters))
        bounds = (0, 8, 12, 16, 32, TOGETHER)
        for least, most in zip(bounds, bounds[1:], strict=False):
            at = np.flatnonzero(~alone & (sizes > least) & (sizes <= most))
            if not len(at):
                continue
            column = np.arange(most)
            place = (ends - sizes)[at, None] + column
            rows = np.where(column < sizes[at, None], symbols[np.minimum(place, len(symbols) - 1)], -1)
            left = np.arange(len(at))
            while len(left):
                m = rows[left]
                key = m[:, :-1] * self.size + m[:, 1:]
                i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = np.where((self.keys[i] == key) & (m[:, 1:] >= 0), self.ranks[i], NEVER)
                best = rank.argmin(1)
                each = np.arange(len(left))
                go = rank[each, best] < NEVER
                left, m, best, i = left[go], m[go], best[go], i[go]
                each = np.arange(len(left))
                m = np.take_along_axis(np.pad(m, ((0, 0), (0, 1)), constant_values=-1), column + (column > best[:, None]), 1)
                m[each, best] = self.merged[i[each, best]]
                rows[left] = m
            for k, row in zip(at, rows.tolist(), strict=True):
                out[k] = row[: row.index(-1)] if row[-1] < 0 else row
        return out

    def pieces_many(self, words: list[str]) -> list[list[int]]:
        """The ids of pre-tokens: proposals, a check of all adjacent pairs, exact merging where it fails."""
        raw = [w.encode() for w in words]
        found = [self.propose(r.decode("latin-1").translate(self.letters)) for r in raw]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(found)), sizes)
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        bad = np.zeros(len(found), bool)
        bad[owner[pair[~self.compatible(flat[pair], flat[pair + 1])]]] = True
        bad[owner[flat < 0]] = True
        failed = np.flatnonzero(bad)
        if len(failed):
            for k, ids in zip(failed, self.merge_many([raw[k] for k in failed]), strict=True):
                found[k] = ids
        return found

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if not new:
            return
        letters = sum(map(len, new))
        if 2 * (len(self.known) + len(new)) > REMEMBERED or 2 * (self.letters_known + letters) > REMEMBERED_LETTERS:
            older = self.known
            self.forget()
            self.older = older
            new = [w for w in words if w not in self.known]
            letters = sum(map(len, new))
        self.letters_known += letters
        older = self.older
        self.known.update((w, older[w]) for w in new if w in older)
        if fresh := [w for w in new if w not in older]:
            ids = self.pieces_many(fresh)
            packed = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
            ends = np.cumsum([4 * len(i) for i in ids]).tolist()
            self.known.update((w, packed[a:b]) for w, a, b in zip(fresh, [0, *ends], ends, strict=False))

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text; special strings are pre-tokens of their own."""
        if self.special_at is None or "<" not in text:
            return self._words(text)
        out: list[str] = []
        for k, part in enumerate(self.special_at.split(text)):
            out += [part] if k % 2 else self._words(part)
        return out

    def _words(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.odd.search(text):
            return self.quick.findall(text.lower())
        spelled = self.splitter.pre_tokenize_str(self.normaliser.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, s)).decode() for s, _ in spelled]

    def chunks(self, text: str):
        """Parts of a text cut at spaces, which no pre-token or special string holds."""
        at = 0
        while len(text) - at > CHUNK:
            cut = text.rfind(" ", at + CHUNK // 2, at + CHUNK)
            cut = text.find(" ", at + CHUNK) if cut < 0 else cut
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def decode_spaced(self, ids: bytes) -> bytes:
        """Token strings, each after a space: without a decoder the library joins tokens by spaces."""
        return b"".join(map(self.spaced.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> WordBpe:
    """One copy in each Python worker."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: bool = False, decoded: bool = False) -> DataFrame:
    """Add n_tokens, ids_sha256, decoded_sha256 (and on demand ids, array<int>, and decoded, string) to each row of ``docs``; its text column goes.

    There is no shuffle: each task encodes its rows. A null text counts as empty: no tokens, the digests of nothing.
    Repeated rows stay repeated, and an empty table gives none. Equal ranks merge from left to right. Columns of ``docs`` with the names of added ones are replaced.
    """
    small_batches(docs.sparkSession)
    added = [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    added += [("ids", "array<int>", pa.list_(pa.int32()))] * ids + [("decoded", "string", pa.string())] * decoded
    kept = [c for c in docs.columns if c != text and c not in [a[0] for a in added]]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))

    def run(batches):
        bpe = vocabulary(path)
        for batch in batches:
            rows = round_trips(bpe, [t or "" for t in batch.column("__text").to_pylist()])
            got = {"n_tokens": [len(r[0]) // 4 for r in rows], "ids_sha256": [hashlib.sha256(r[0]).hexdigest() for r in rows], "decoded_sha256": [hashlib.sha256(r[1]).hexdigest() for r in rows]}
            got |= {"ids": [np.frombuffer(r[0], "<i4") for r in rows]} if ids else {}
            got |= {"decoded": [r[1].decode() for r in rows]} if decoded else {}
            cols = [batch.column(c) for c in kept] + [pa.array(got[n], kind) for n, _, kind in added]
            yield pa.RecordBatch.from_arrays(cols, [*kept, *(n for n, _, _ in added)])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + [f"{n} {kind}" for n, kind, _ in added]
    return source.mapInArrow(thrifty(run), ", ".join(fields))


def round_trips(bpe: WordBpe, texts: list[str]) -> list[tuple[bytes, bytes]]:
    """The packed ids of each text and, decoded from them, the text they stand for (UTF-8). What is new in some CHUNK characters of texts is learnt together."""
    out: list[tuple[list[bytes], list[bytes]]] = [([], []) for _ in texts]
    held: list[tuple[int, list[str]]] = []
    size = 0

    def encode_held() -> None:
        bpe.learn(set(chain.from_iterable(words for _, words in held)))
        for row, words in held:
            ids = b"".join(map(bpe.known.__getitem__, words))
            out[row][0].append(ids)
            out[row][1].append(bpe.decode_spaced(ids))

    for row, text in enumerate(texts):
        for part in bpe.chunks(text):
            held.append((row, bpe.words(part)))
            size += len(part)
            if size >= CHUNK:
                encode_held()
                held, size = [], 0
    encode_held()
    return [(b"".join(ids), b"".join(shown)[1:]) for ids, shown in out]  # no space before the first token


def round_trip(bpe: WordBpe, text: str) -> tuple[bytes, bytes]:
    return round_trips(bpe, [text])[0]


def piece_counts(bpe: WordBpe, words: list[str]) -> list[int]:
    return [1 if w in bpe.special else len(p) for w, p in zip(words, bpe.pieces_many(words), strict=True)]


def word_counts(bpe: WordBpe, text: str) -> Counter:
    """How often each pre-token occurs in a text."""
    out: Counter = Counter()
    for part in bpe.chunks(text):
        out.update(bpe.words(part))
    return out
