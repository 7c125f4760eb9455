"""Hard negatives by product quantisation with residual bounds and an exact rerank.

A vector is cut into sub-vectors, each replaced by the number of its nearest centroid; the norms of what is left over are stored beside. A table of an
anchor's inner products with all centroids gives every row's score but for the residuals, and by the Cauchy-Schwarz inequality these change it by no more than the sum of
products of the anchor's and the row's norms. So a row's score lies between two bounds, and rows whose upper bound misses what enough others surely reach need no look. Those left
are scored in integers, so the result does not depend on the centroids, which are fitted on a bounded sample.

Two passes over blocks of the index and chunks of anchors, which meet by a join on the cells of a grid: the best rows of an anchor's own label, then, for each of them, the best rows of other labels in
its window of scores. The best of each block are merged by anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizloom.llm.bsi_topk import KINDS, quantised
from quizloom.llm.common import Scratch, on_a_grid, small_batches, thrifty

#: Rows of an index block on average, and anchors of a chunk at most; anchors scored at a time.
BLOCK, CHUNK, AT_ONCE = 4096, 4096, 64
#: Dimensions of a sub-vector, centroids of one, rows they are fitted on, and rounds of fitting.
WIDTH, CENTROIDS, SAMPLE, ROUNDS = 2, 256, 8192, 6


def parts(dim: int) -> list[slice]:
    return [slice(k, min(k + WIDTH, dim)) for k in range(0, dim, WIDTH)]


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each sub-vector; any choice keeps the bounds."""
    c = centroids.astype(np.float64)
    out = np.empty(len(x), np.int64)
    for k in range(0, len(x), 8192):
        out[k : k + 8192] = np.argmin((c * c).sum(1) - 2 * (x[k : k + 8192].astype(np.float64) @ c.T), axis=1)
    return out


def fit(vectors: np.ndarray) -> list[np.ndarray]:
    """Integer centroids of each sub-vector by Lloyd's rounds over the sample, from rows spread over its order."""
    out = []
    for p in parts(vectors.shape[1]):
        x = vectors[:, p]
        c = np.unique(x[np.linspace(0, len(x) - 1, min(CENTROIDS, len(x))).astype(np.int64)], axis=0)
        for _ in range(ROUNDS):
            own = nearest(x, c)
            n = np.bincount(own, minlength=len(c))
            total = np.stack([np.bincount(own, x[:, j].astype(np.float64), len(c)) for j in range(x.shape[1])], 1)
            c = np.where(n[:, None] > 0, np.rint(total / np.maximum(n, 1)[:, None]), c).astype(np.int64)
        out.append(c)
    return out


def norms(x: np.ndarray) -> np.ndarray:
    """Euclidean norms of the sub-vectors of each row, by sub-vector, rounded up."""
    return np.stack([np.sqrt((x[:, p].astype(np.float64) ** 2).sum(1)) for p in parts(x.shape[1])]) * (1 + 1e-9)


def encode(vectors: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, residual norms), both by sub-vector and row."""
    codes = np.stack([nearest(vectors[:, p], c) for p, c in zip(parts(vectors.shape[1]), books, strict=True)])
    left = vectors - np.concatenate([c[k] for c, k in zip(books, codes, strict=True)], 1)
    return codes.astype(np.uint8), np.nextafter(norms(left).astype(np.float32), np.float32(np.inf))


def bounds(anchors: np.ndarray, books: list[np.ndarray], codes: np.ndarray, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high): between what each row's score with each anchor lies."""
    score = np.zeros((len(anchors), codes.shape[1]), np.int64)
    for p, c, k in zip(parts(anchors.shape[1]), books, codes, strict=True):
        score += np.take(anchors[:, p] @ c.T, k, axis=1)
    off = np.ceil((norms(anchors).T @ residual.astype(np.float64)) * (1 + 1e-9)).astype(np.int64)
    return score - off, score + off


def kth_largest(x: np.ndarray, k: int) -> int:
    return int(np.partition(x, len(x) - k)[len(x) - k])


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


class Block:
    """Rows of the index in order of label and id."""

    def __init__(self, r: dict, books: dict[int, list[np.ndarray]]):
        self.dim = r["dim"]
        self.ids, self.labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
        self.vectors = np.frombuffer(r["vectors"], f"<i{r['width']}").astype(np.int64).reshape(-1, self.dim)
        self.books = books_for(books, self.dim)
        m = len(parts(self.dim))
        self.codes, self.residual = np.frombuffer(r["codes"], np.uint8).reshape(m, -1), np.frombuffer(r["norms"], np.float32).reshape(m, -1)


def books_for(books: dict[int, list[np.ndarray]], dim: int) -> list[np.ndarray]:
    """Centroids for vectors of a dimension; if the sample has none of it, the origin alone."""
    return books.get(dim) or [np.zeros((1, p.stop - p.start), np.int64) for p in parts(dim)]


def positives_in(b: Block, anchor_ids: np.ndarray, anchor_labels: np.ndarray, anchors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor number, row ids, scores) of the k best rows of its own label for each anchor, without itself."""
    for label in np.unique(anchor_labels):
        a, z = np.searchsorted(b.labels, label, "left"), np.searchsorted(b.labels, label, "right")
        asking = np.flatnonzero(anchor_labels == label)
        for k0 in range(0, len(asking) if z > a else 0, AT_ONCE):
            some = asking[k0 : k0 + AT_ONCE]
            low, high = bounds(anchors[some], b.books, b.codes[:, a:z], b.residual[:, a:z])
            for n, lo, hi in zip(some, low, high, strict=True):
                other = b.ids[a:z] != anchor_ids[n]
                if other.sum() > k:
                    other &= hi >= kth_largest(lo[other], k)
                at = a + np.flatnonzero(other)
                score = b.vectors[at] @ anchors[n]
                top = best(b.ids[at], score, k)
                yield int(n), b.ids[at[top]], score[top]


def negatives_in(b: Block, anchor_labels: np.ndarray, anchors: np.ndarray, windows: list[list[tuple[int, int]]], k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor number, window number, row ids, scores) of the k best rows of other labels with a score within each window (from, to) of an anchor."""
    for k0 in range(0, len(anchors), AT_ONCE):
        low, high = bounds(anchors[k0 : k0 + AT_ONCE], b.books, b.codes, b.residual)
        for n, (lo, hi) in enumerate(zip(low, high, strict=True), k0):
            other = b.labels != anchor_labels[n]
            for w, (least, most) in enumerate(windows[n]):
                if least > most:
                    continue
                may = other & (hi >= least) & (lo <= most)
                sure = lo[other & (lo >= least) & (hi <= most)]
                if len(sure) >= k:
                    may &= hi >= kth_largest(sure, k)
                at = np.flatnonzero(may)
                score = b.vectors[at] @ anchors[n]
                good = (score >= least) & (score <= most)
                at, score = at[good], score[good]
                top = best(b.ids[at], score, k)
                if len(top):
                    yield n, w, b.ids[at[top]], score[top]


def packed(values: np.ndarray) -> tuple[int, bytes]:
    """Integers in the narrowest type that holds them: its width, and the bytes."""
    kind = next(t for t in KINDS if np.iinfo(t).min <= values.min() and values.max() <= np.iinfo(t).max)
    return np.dtype(kind).itemsize, values.astype(kind).tobytes()


def matrix(group: pa.Table) -> np.ndarray:
    return np.array(group["q"].combine_chunks().flatten().to_numpy()).reshape(group.num_rows, -1)


def mine(rows: DataFrame, anchors: Callable[[Column], Column], positives: int = 5, negatives: int = 3, percent: tuple[int, int] = (50, 95), scale: int = 256, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", block: int = BLOCK, chunk: int | None = None, sample_rows: int = SAMPLE) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``anchors`` tells by the id which rows are anchors. Components become floor(scale * x); a row's score is its integer inner product with the anchor. The positives of an anchor are its ``positives`` best
    other rows of its label; for each, the ``negatives`` best rows of other labels with a score of ``percent`` of the positive's, both ends included, are returned; all, if there are fewer. Higher scores come
    first, ties by smaller id. A positive of negative score has no such rows.

    Rows without id or label, and vectors that are null, empty or hold a null or non-finite component, take no part; of rows with equal ids one does, that of the smallest label, then vector. A row
    meets rows of its own dimension only. An empty table gives none. Other columns are not read. Integers and scores must fit 60 bits. Centroids are fitted on ``sample_rows`` rows at most; every row is indexed.
    """
    spark = rows.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "negatives")
    known = rows.where(F.col(f"`{label}`").isNotNull())
    plain = quantised(known, id_col, vector, scale, F.col(f"`{label}`").cast("long").alias("label"))
    base = scratch.save(plain.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q"), "rows")
    asked = anchors(F.col("id"))
    n_rows, n_anchors = base.agg(F.count("*"), F.count_if(asked)).first()
    blocks = max(1, -(-n_rows // block))
    chunk = chunk or min(CHUNK, max(128, -(-n_anchors * blocks // (2 * spark.sparkContext.defaultParallelism))))
    chunks = max(1, -(-n_anchors // chunk))
    drawn: dict[int, list] = {}
    for r in base.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("q").toArrow()["q"].to_pylist():
        drawn.setdefault(len(r), []).append(r)
    books = {dim: fit(np.array(v, np.int64)) for dim, v in drawn.items()}
    dim = F.size("q").cast("long").alias("dim")

    def pack_rows(key, group):
        ids, labels, v = group["id"].to_numpy(), group["label"].to_numpy(), matrix(group)
        order = np.lexsort((ids, labels))
        ids, labels, v = ids[order], labels[order], v[order]
        codes, residual = encode(v, books_for(books, v.shape[1]))
        width, data = packed(v)
        row = {"block": key[0].as_py(), "dim": v.shape[1], "ids": ids.tobytes(), "labels": labels.tobytes(), "width": width, "vectors": data, "codes": codes.tobytes(), "norms": residual.tobytes()}
        return pa.table({k: pa.array([x], pa.binary() if isinstance(x, bytes) else pa.int64()) for k, x in row.items()})

    def pack_anchors(key, group):
        width, data = packed(matrix(group))
        row = {"chunk": key[0].as_py(), "dim": key[1].as_py(), "anchor_ids": group["id"].to_numpy().tobytes(), "anchor_labels": group["label"].to_numpy().tobytes(), "anchor_width": width, "anchors": data}
        cols = {k: pa.array([x], pa.binary() if isinstance(x, bytes) else pa.int64()) for k, x in row.items()}
        kind = pa.list_(pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())])))
        return pa.table(cols | {"positives": pa.array([group["positives"].to_pylist()], kind)})

    index = base.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), dim).applyInArrow(pack_rows, "block long, dim long, ids binary, labels binary, width long, vectors binary, codes binary, norms binary")
    index = scratch.save(index, "index")
    def meet(chosen: DataFrame, run, schema: str) -> DataFrame:
        """``run`` over every block beside every chunk of its dimension."""
        pack = chosen.groupBy(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).alias("chunk"), dim)
        pack = pack.applyInArrow(pack_anchors, "chunk long, dim long, anchor_ids binary, anchor_labels binary, anchor_width long, anchors binary, positives array<array<struct<id:long,score:long>>>")
        met = on_a_grid(index, pack, blocks, chunks, n_rows / max(1, n_anchors), ("dim",))

        def pairs(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    b = Block(r, books)
                    ids, labels = np.frombuffer(r["anchor_ids"], np.int64), np.frombuffer(r["anchor_labels"], np.int64)
                    vectors = np.frombuffer(r["anchors"], f"<i{r['anchor_width']}").astype(np.int64).reshape(-1, b.dim)
                    yield from run(b, ids, labels, vectors, r["positives"])

        return met.mapInArrow(thrifty(pairs), schema)

    def batch_of(names: list[str], cols: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in cols], names)

    def near(b, ids, labels, vectors, _):
        found = list(positives_in(b, ids, labels, vectors, positives))
        yield from batch_of(["anchor_id", "positive_id", "positive_score"], [[np.full(len(i), ids[n]) for n, i, _ in found], [i for _, i, _ in found], [s for _, _, s in found]])

    def hard(b, ids, labels, vectors, chosen):
        windows = [[(-(-percent[0] * p["score"] // 100), percent[1] * p["score"] // 100) for p in ps] for ps in chosen]
        found = list(negatives_in(b, labels, vectors, windows, negatives))
        own = [(n, chosen[n][w], i, s) for n, w, i, s in found]
        cols = [[np.full(len(i), ids[n]) for n, _, i, _ in own], [np.full(len(i), p["id"]) for _, p, i, _ in own], [np.full(len(i), p["score"]) for _, p, i, _ in own], [i for *_, i, _ in own], [s for *_, s in own]]
        yield from batch_of(["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"], cols)

    wanted = base.where(asked)
    first = meet(wanted.withColumn("positives", F.array().cast("array<struct<id:long,score:long>>")), near, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    first = first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    first = scratch.save(first.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")), "positives")
    found = meet(wanted.join(first, "id"), hard, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
