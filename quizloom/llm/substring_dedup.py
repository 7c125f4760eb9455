"""Removal of repeated passages by fixed-block anchors.

Any window of 2b - 1 words holds a whole block of an arrangement in non-overlapping blocks of b words. So the blocks of
every document are the index, every rolling window of b words is a probe, and a repeated passage of at least 2b - 1
words gives a hit. The windows around a hit, to both sides, are then looked up with the place where the smallest document has them, and a hit is extended
as long as neighbouring windows stand at neighbouring places of the same document: that is the maximal exact repeat, and its words are what the later document loses. Windows are equal if 96 bits of two
hashes are: among 10 ** 13 of them less than 0.001 false pairs are to be expected.

Documents travel once, in packs of some MB. A pack sends each distinct hash once to the part of the hash range it lies in,
compressed, and gets back which of them matter; texts are never sent for a hash. A passage that a third of all documents share is
one hash a pack.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import SPACES, Scratch, shuffle_partitions, small_batches, thrifty
from quizloom.llm.words import OTHER, WordHashes, window_hashes

#: UTF-8 bytes of a pack, about, and words whose hashes a part of the hash range gets on average.
PACK_BYTES, PART_WORDS = 3_000_000, 2_000_000
NO_DOC = np.int64(2**63 - 1)


def squeeze(a: np.ndarray) -> bytes:
    """Integers by byte planes, compressed."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())


def unsqueeze(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


def squeeze_sorted(a: np.ndarray) -> bytes:
    return squeeze(np.diff(a, prepend=a.dtype.type(0)))


def unsqueeze_sorted(data: bytes, kind) -> np.ndarray:
    return np.cumsum(unsqueeze(data, kind), dtype=kind)


def part_bounds(values: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the hash range begins in sorted hashes."""
    edges = np.array([(p << 64) // parts for p in range(parts)], np.uint64)
    return np.append(np.searchsorted(values, edges), len(values))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; a plain sort is several times as fast as numpy's own way."""
    v = np.sort(values)
    return v[np.append(True, v[1:] != v[:-1])] if len(v) else v


def member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


class Pack:
    """Words and windows of the documents of a pack. Documents without id take no part in comparisons."""

    def __init__(self, blob: bytes, key: str, text: str, known: WordHashes):
        self.batch = pa.ipc.open_stream(blob).read_next_batch()
        ids = self.batch.column(self.batch.schema.get_field_index(key))
        self.texts = self.batch.column(self.batch.schema.get_field_index(text)).to_pylist()
        self.words = [(t or "").encode("utf-8", "surrogatepass").split() for t in self.texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *map(known.array, self.words)])
        own = np.array([NO_DOC if i is None else i for i in ids.to_pylist()], np.int64)
        self.doc = np.repeat(own, self.sizes)  # of each word
        self.max_doc = int(own[own != NO_DOC].max(initial=-(2**63)))
        self.room = np.where(self.doc == NO_DOC, 0, np.repeat(self.ends, self.sizes) - np.arange(len(self.doc)))  # words to the document's end
        self.at = np.arange(len(self.doc)) - np.repeat(self.ends - self.sizes, self.sizes)

    def windows(self, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the windows within documents of at least ``least`` words."""
        h = window_hashes(self.hashes, size)
        long = np.repeat(self.sizes >= least, self.sizes)
        starts = np.flatnonzero((self.room >= size)[: len(h)] & long[: len(h)])
        return starts, h[starts]

    def checks(self, size: int, starts: np.ndarray) -> np.ndarray:
        """32 bits more of the windows at these places."""
        return (window_hashes(self.hashes, size, OTHER)[starts] >> np.uint64(32)).astype(np.uint32)


def groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order that sorts the values, where each distinct value begins in it)."""
    order = np.argsort(values)
    v = values[order]
    return order, np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, np.int64)


def smallest(values: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in ascending order, the smallest document of each, and whether it has others."""
    order, first = groups(values)
    if not len(first):
        return values, docs, np.zeros(0, bool)
    d = docs[order]
    low = np.minimum.reduceat(d, first)
    return values[order[first]], low, np.maximum.reduceat(d, first) > low


def smallest_of_windows(values: np.ndarray, checks: np.ndarray, docs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts windows by both hashes, where each distinct one begins in it, and which of its occurrences has the smallest document and the first place there."""
    order = np.argsort(values)
    v, c = values[order], checks[order]
    if ((v[1:] == v[:-1]) & (c[1:] != c[:-1])).any():  # windows that share the first hash only
        order = np.lexsort((checks, values))
        v, c = values[order], checks[order]
    first = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (c[1:] != c[:-1]))) if len(v) else np.zeros(0, np.int64)
    by_place = np.lexsort((places, docs))
    rank = np.empty(len(order), np.int64)
    rank[by_place] = np.arange(len(order))
    return order, first, by_place[np.minimum.reduceat(rank[order], first)] if len(first) else first


def extended(starts: np.ndarray, sources: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first window, words) of each maximal repeat: neighbouring windows, in ascending order, that the same document has at neighbouring places."""
    joined = (np.diff(starts) == 1) & (np.diff(sources) == 0) & (np.diff(places) == 1)
    first = np.flatnonzero(np.append(True, ~joined)) if len(starts) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(starts))) + window - 1


def find_windows(values: np.ndarray, checks: np.ndarray, wanted: np.ndarray, wanted_checks) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``wanted`` are among windows sorted by both hashes, and their places there); ``wanted_checks`` gives the second hash of those asked for."""
    order = np.argsort(wanted)  # places are found faster in order
    at = np.empty(len(wanted), np.int64)
    at[order] = np.searchsorted(values, wanted[order])
    asked = np.flatnonzero(values[np.minimum(at, len(values) - 1)] == wanted) if len(values) else np.zeros(0, np.int64)
    asked = asked[at[asked] < len(values)]
    place, check = at[asked], wanted_checks(asked)
    todo = np.flatnonzero(checks[place] != check)
    while len(todo):  # windows that share the first hash only
        place[todo] += 1
        inside = place[todo] < len(values)
        inside[inside] = values[place[todo[inside]]] == wanted[asked[todo[inside]]]
        place[todo[~inside]] = -1
        todo = todo[inside]
        todo = todo[checks[place[todo]] != check[todo]]
    return asked[place >= 0], place[place >= 0]


def within(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The top 32 bits of a hash's place in its part, in the order of the hashes."""
    return ((hashes * np.uint64(parts)) >> np.uint64(32)).astype(np.uint32)


def matched(rows: list[dict]) -> list[np.ndarray]:
    """For each pack of a part, which of its distinct probes another pack's block matters to, or the other way round."""
    values = [unsqueeze_sorted(r["probes"], np.uint32) for r in rows]
    is_block = [np.unpackbits(np.frombuffer(r["blocks"], np.uint8), count=len(v)).view(bool) for r, v in zip(rows, values, strict=True)]
    pack = np.repeat(np.arange(len(rows)), [len(v) for v in values])
    most = np.array([r["max_doc"] for r in rows], np.int64)
    v, block = np.concatenate(values), np.concatenate(is_block)
    bv, bp, bd = v[block], pack[block], np.concatenate([unsqueeze(r["docs"], np.int64) for r in rows])
    hit = np.zeros(len(v), bool)
    if len(bv):
        # of each block hash the smallest document, its pack, and the smallest one of other packs
        order, first = groups(bv)
        sv, sp, sd = bv[order], bp[order], bd[order]
        size = np.diff(np.append(first, len(sv)))
        uv, d1 = sv[first], np.minimum.reduceat(sd, first)
        p1 = np.maximum.reduceat(np.where(sd == np.repeat(d1, size), sp, -1), first)
        d2 = np.minimum.reduceat(np.where(sp == np.repeat(p1, size), NO_DOC, sd), first)
        i = np.minimum(np.searchsorted(uv, v), len(uv) - 1)
        hit = (uv[i] == v) & (np.where(p1[i] == pack, d2[i], d1[i]) < most[pack])
        # of each probe hash the pack with the largest document, and the next such pack
        by_most = np.argsort(-most, kind="stable")
        rank = np.empty(len(most), np.uint64)
        rank[by_most] = np.arange(len(most), dtype=np.uint64)
        both = np.sort((v.astype(np.uint64) << np.uint64(32)) | rank[pack])
        sv, sp = (both >> np.uint64(32)).astype(np.uint32), by_most[(both & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        first = np.flatnonzero(np.append(True, sv[1:] != sv[:-1]))
        nxt = np.minimum(first + 1, len(sv) - 1)
        x2 = np.where((nxt > first) & (sv[nxt] == sv[first]), most[sp[nxt]], -(2**63))
        j = np.searchsorted(sv[first], bv)
        hit[block] |= np.where(sp[first][j] == bp, x2[j], most[sp[first]][j]) > bd
    return np.split(hit, np.cumsum([len(x) for x in values])[:-1])


def make_packs(docs: DataFrame, text: str) -> DataFrame:
    """pack, n_words, blob: the rows of ``docs`` as compressed Arrow streams."""
    names = docs.columns

    def run(batches):
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def out():
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as w:
                w.write_batch(table)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["pack", "bytes", "blob"])

        for batch in batches:
            lengths = np.array([len(t) if t else 0 for t in batch.column(names.index(text)).to_pylist()])
            at = 0
            while at < len(lengths):
                n = int(np.searchsorted(np.cumsum(lengths[at:]), PACK_BYTES - size)) + 1
                part = batch.slice(at, n)
                held.append(pa.RecordBatch.from_arrays(part.columns, names))
                size += int(lengths[at : at + n].sum())
                at += n
                if size >= PACK_BYTES:
                    yield out()
                    number, held, size = number + 1, [], 0
        if held:
            yield out()

    return docs.mapInArrow(thrifty(run), "pack long, bytes long, blob binary")


def drop_repeats(docs: DataFrame, window: int = 13, key: str = "doc_id", text: str = "text", rewrite: bool = True, bits: int = 64, repeats: bool = False) -> DataFrame:
    """Add n_words, n_removed and kept_sha256 (of the kept words joined by one space) to each row of ``docs``.

    Words are runs of anything but ASCII white space. A word goes if a window of ``window`` words (an odd number, 3 at least) that covers it also starts in a row with a smaller key;
    windows are judged on the input. With ``rewrite`` the text column keeps what is left with its white space, else it
    goes. With ``repeats`` there is also an array of the maximal repeats: start and length in words, the document with the smallest key that has all its windows, and where the repeat starts there; they may
    overlap. Null texts have no words and stay null, texts without a removed word stay as they are. Rows without key neither lose words nor
    make others lose any; rows with equal keys do not count against each other. An empty table gives none. Columns of ``docs`` with the names of added ones are replaced.
    Keys are integers; a text that is none is an error. ``bits`` of the first window hash are used; fewer than 64 are for tests, as the second one has to tell windows apart then.
    """
    dropped = np.uint64(64 - bits)
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "substrings")
    added = ["n_words", "n_removed", "kept_sha256", *["repeats"] * repeats]
    docs = docs.drop(*added)
    docs = docs.withColumn(key, F.col(key).cast("long"))
    size = (window + 1) // 2
    # dealt once and written, so that later only what is found is sent to the packs, and all steps see the same packs whatever order the input comes in
    packs = scratch.save_dealt(make_packs(docs, text), "packs", "pack", shuffle_partitions(spark))
    total = packs.agg(F.sum("bytes")).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-total // 6 // PART_WORDS), 1)

    def probe(batches):
        known = WordHashes()
        for batch in batches:
            for number, blob in zip(batch.column("pack").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                p = Pack(blob, key, text, known)
                starts, h = p.windows(size, window)
                aligned = p.at[starts] % size == 0
                bv, bd, _ = smallest(h[aligned], p.doc[starts[aligned]])
                values = distinct(h)
                block = member(bv, values)
                bounds, cut = part_bounds(values, parts), np.searchsorted(bv, values)
                short, rows = within(values, parts), []
                for k in np.flatnonzero(np.diff(bounds)):
                    a, b = bounds[k], bounds[k + 1]
                    docs_of = bd[cut[a:b][block[a:b]]]
                    rows.append((int(k), number, p.max_doc, squeeze_sorted(short[a:b]), np.packbits(block[a:b]).tobytes(), squeeze(docs_of)))
                if rows:
                    kinds = [pa.int64()] * 3 + [pa.binary()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "pack", "max_doc", "probes", "blocks", "docs"])

    def match(key_, group):
        rows = group.to_pylist()
        hits = [(r["pack"], r["part"], zstandard.ZstdCompressor(1).compress(np.packbits(m).tobytes())) for r, m in zip(rows, matched(rows), strict=True) if m.any()]
        return pa.table({n: pa.array([h[i] for h in hits], t) for i, (n, t) in enumerate((("pack", pa.int64()), ("part", pa.int64()), ("mask", pa.binary())))})

    sent = packs.select("pack", "blob").mapInArrow(thrifty(probe), "part long, pack long, max_doc long, probes binary, blocks binary, docs binary")
    hits = sent.groupBy("part").applyInArrow(match, "pack long, part long, mask binary")
    hits = scratch.save(hits.groupBy("pack").agg(F.collect_list(F.struct("part", "mask")).alias("hits")), "hits")

    def candidates(batches):
        known = WordHashes()
        for batch in batches:
            for number, blob, found in zip(*(batch.column(c).to_pylist() for c in ("pack", "blob", "hits")), strict=True):
                p = Pack(blob, key, text, known)
                starts, h = p.windows(size, window)
                order, first = groups(h)
                values = h[order[first]]
                d = p.doc[starts[order]]
                hot = np.minimum.reduceat(d, first) < np.maximum.reduceat(d, first) if len(first) else np.zeros(0, bool)  # shared within the pack
                bounds = part_bounds(values, parts)
                for f in found or ():
                    a, b = bounds[f["part"]], bounds[f["part"] + 1]
                    hot[a:b] |= np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(f["mask"]), np.uint8), count=b - a).view(bool)
                at = np.zeros(len(p.doc) + window, np.int64)
                at[starts[order[np.repeat(hot, np.diff(np.append(first, len(h))))]] + 1] = 1
                so_far = np.cumsum(at)
                wide, g = p.windows(window, window)
                near = so_far[wide + size] > so_far[wide]  # a hit begins among the first ``size`` words
                gv, gc, gd, gp = g[near] >> dropped << dropped, p.checks(window, wide[near]), p.doc[wide[near]], p.at[wide[near]].astype(np.uint32)
                order, first, best = smallest_of_windows(gv, gc, gd, gp)
                several = np.maximum.reduceat(gd[order], first) > gd[best] if len(first) else np.zeros(0, bool)
                gv, gc, gd, gp = (x[best] for x in (gv, gc, gd, gp))
                bounds, rows = part_bounds(gv, parts), []
                for k in np.flatnonzero(np.diff(bounds)):
                    a, b = bounds[k], bounds[k + 1]
                    rows.append((int(k), number, squeeze_sorted(gv[a:b]), squeeze(gc[a:b]), squeeze(gd[a:b]), squeeze(gp[a:b]), np.packbits(several[a:b]).tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 2 + [pa.binary()] * 5, strict=True)], ["part", "pack", "windows", "checks", "docs", "places", "several"])

    def judge(key_, group):
        rows = group.to_pylist()
        values = [unsqueeze_sorted(r["windows"], np.uint64) for r in rows]
        checks = [unsqueeze(r["checks"], np.uint32) for r in rows]
        docs_of = [unsqueeze(r["docs"], np.int64) for r in rows]
        docs_in, places = np.concatenate(docs_of), np.concatenate([unsqueeze(r["places"], np.uint32) for r in rows])
        order, first, best = smallest_of_windows(np.concatenate(values), np.concatenate(checks), docs_in, places)
        keepers = np.empty(len(order), np.int64)  # for each window, the one that keeps it
        keepers[order] = np.repeat(best, np.diff(np.append(first, len(order))))
        out = []
        for r, v, c, own, keeper in zip(rows, values, checks, docs_of, np.split(keepers, np.cumsum([len(v) for v in values])[:-1]), strict=True):
            lost = (docs_in[keeper] < own) | np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(v)).view(bool)
            if lost.any():
                out.append((r["pack"], squeeze_sorted(v[lost]), squeeze(c[lost]), squeeze(docs_in[keeper[lost]]), squeeze(places[keeper[lost]])))
        return pa.table({n: pa.array([o[i] for o in out], t) for i, (n, t) in enumerate((("pack", pa.int64()), ("lost", pa.binary()), ("checks", pa.binary()), ("to", pa.binary()), ("at", pa.binary())))})

    asked = packs.select("pack", "blob").join(hits.hint("shuffle_hash"), "pack", "left").mapInArrow(thrifty(candidates), "part long, pack long, windows binary, checks binary, docs binary, places binary, several binary")
    lost = asked.groupBy("part").applyInArrow(judge, "pack long, lost binary, checks binary, to binary, at binary")
    lost = scratch.save(lost.groupBy("pack").agg(F.collect_list(F.struct("lost", "checks", "to", "at")).alias("lost")), "lost")
    scratch.drop("hits")

    kept = [c for c in docs.columns if rewrite or c != text]

    def clean(batches):
        known = WordHashes()
        for batch in batches:
            for blob, found in zip(batch.column("blob").to_pylist(), batch.column("lost").to_pylist(), strict=True):
                p = Pack(blob, key, text, known)
                starts, g = p.windows(window, window)
                # windows that some document of the pack loses, and the document that keeps each
                gone = np.concatenate([np.zeros(0, np.uint64), *(unsqueeze_sorted(x["lost"], np.uint64) for x in found or ())])
                checks = np.concatenate([np.zeros(0, np.uint32), *(unsqueeze(x["checks"], np.uint32) for x in found or ())])
                keeper = np.concatenate([np.zeros(0, np.int64), *(unsqueeze(x["to"], np.int64) for x in found or ())])
                places = np.concatenate([np.zeros(0, np.uint32), *(unsqueeze(x["at"], np.uint32) for x in found or ())]).astype(np.int64)
                order = np.lexsort((checks, gone))
                which, at = find_windows(gone[order], checks[order], g >> dropped << dropped, lambda k, p=p, starts=starts: p.checks(window, starts[k]))
                at = order[at]
                bad = keeper[at] < p.doc[starts[which]]
                which, at = which[bad], at[bad]
                first, length = extended(starts[which], keeper[at], places[at], window)
                begin = starts[which[first]]
                edge = np.zeros(len(p.doc) + 1, np.int64)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + length, -1)
                keep = np.cumsum(edge[:-1]) == 0
                removed, shas, texts = [], [], []
                for k, (words, end) in enumerate(zip(p.words, p.ends, strict=True)):
                    own = keep[end - len(words) : end]
                    n = len(words) - int(own.sum())
                    left = words if not n else [words[i] for i in np.flatnonzero(own)]
                    removed.append(n)
                    shas.append(hashlib.sha256(b" ".join(left)).hexdigest())
                    if rewrite:
                        texts.append(cut(p.texts[k], own) if n else p.texts[k])
                cols = [pa.array(texts, pa.string()) if c == text else p.batch.column(p.batch.schema.get_field_index(c)) for c in kept]
                cols += [pa.array(p.sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas)]
                if repeats:
                    row = np.searchsorted(p.ends, begin, "right")  # the document of each repeat
                    spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (p.at[begin], length, keeper[at[first]], places[at[first]])], ["start", "length", "source", "source_start"])
                    cols.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(p.sizes) + 1)), pa.int32()), spans))
                yield pa.RecordBatch.from_arrays(cols, [*kept, *added])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept)
    return packs.select("pack", "blob").join(lost.hint("shuffle_hash"), "pack", "left").mapInArrow(thrifty(clean), f"{fields}, n_words long, n_removed long, kept_sha256 string" + ", repeats array<struct<start:long,length:long,source:long,source_start:long>>" * repeats)


PIECE = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def cut(text: str, keep: np.ndarray) -> str:
    """The kept words of a text, each with the white space after it."""
    pieces = PIECE.findall(text)
    return "".join(pieces[i] for i in np.flatnonzero(keep)).rstrip(SPACES)
