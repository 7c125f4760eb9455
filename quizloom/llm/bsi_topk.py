"""Exact top-k inner products over a bit-sliced index.

A block of rows keeps each quantised attribute as bitmaps, one for each binary digit. The score of all rows of a
block is the sum of attribute slices, shifted by the digits of the query and added by carry-save bitmap arithmetic; a
negative factor takes complemented slices. The top rows are then selected from the most significant score slice
downward, and rows tied at the boundary are resolved by their ids. Blocks and query chunks meet by an
equi-join on the cells of a grid, and the k best of each block are merged by query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizloom.llm.common import Scratch, on_a_grid, small_batches, thrifty

#: Rows of an index block on average, and queries of a chunk at most.
BLOCK, CHUNK = 32_768, 8192
#: Integer types that queries are sent as, the narrowest that holds them.
KINDS = (np.int8, np.int16, np.int32, np.int64)


def quantised(rows: DataFrame, id_col: str, vector: str, scale: int, *more: Column) -> DataFrame:
    """id, ``more`` columns, q (array<long> floor(scale * x)); rows with a null id, or a vector that is null, empty or holds a null or non-finite component, go."""
    x = F.col(f"`{vector}`")
    good = F.col(f"`{id_col}`").isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return rows.where(good).select(F.col(f"`{id_col}`").cast("long").alias("id"), *more, F.transform(x, lambda v: F.floor(scale * v.cast("double")).cast("long")).alias("q"))


def pack_rows(key, group):
    """One index block: ids in ascending order, the low end of each attribute and its slices above it."""
    order = np.argsort(ids := group["id"].to_numpy(), kind="stable")
    values = np.array(group["q"].combine_chunks().flatten().to_numpy()).reshape(len(ids), -1)[order]
    low = values.min(0)
    above = (values - low).astype(np.uint64)
    bits = max(1, int(above.max()).bit_length())
    padded = np.zeros((-(-len(ids) // 64) * 64, above.shape[1]), np.uint64)
    padded[: len(ids)] = above
    slices = [np.packbits(((padded >> np.uint64(i)) & np.uint64(1)).astype(bool), axis=0, bitorder="little").T for i in range(bits)]
    data = np.ascontiguousarray(np.stack(slices, 1))  # attribute x digit x bytes
    row = {"block": [key[0].as_py()], "dim": [key[1].as_py()], "ids": [ids[order].tobytes()], "low": [low.tobytes()], "bits": [bits], "slices": [data.tobytes()]}
    return pa.table({k: pa.array(v, {"ids": pa.binary(), "low": pa.binary(), "slices": pa.binary()}.get(k, pa.int64())) for k, v in row.items()})


def pack_queries(key, group):
    ids = group["id"].to_numpy()
    values = np.array(group["q"].combine_chunks().flatten().to_numpy())
    kind = next(k for k in KINDS if np.iinfo(k).min <= values.min() and values.max() <= np.iinfo(k).max)
    row = {"chunk": [key[0].as_py()], "dim": [key[1].as_py()], "query_ids": [ids.tobytes()], "width": [np.dtype(kind).itemsize], "queries": [values.astype(kind).tobytes()]}
    return pa.table({k: pa.array(v, pa.binary() if k in ("query_ids", "queries") else pa.int64()) for k, v in row.items()})


def add_planes(planes: dict[int, list[np.ndarray]]) -> dict[int, np.ndarray]:
    """Sum bitmaps by weight: full adders over thirds of each weight's stack until one bitmap a weight is left."""
    out, w = {}, min(planes, default=0)
    while planes:
        stack = np.concatenate(got, 0) if len(got := planes.pop(w, [])) > 1 else (got[0] if got else None)
        carried = []
        while stack is not None and len(stack) > 1:
            t = len(stack) // 3
            if t:
                a, b, c = stack[:t], stack[t : 2 * t], stack[2 * t : 3 * t]
                half = a ^ b
                carried.append((a & b) | (half & c))
                half ^= c
                stack = np.concatenate([half, stack[3 * t :]], 0) if len(stack) > 3 * t else half
            else:
                carried.append(stack[:1] & stack[1:])
                stack = stack[:1] ^ stack[1:]
        if carried:
            planes.setdefault(w + 1, []).extend(carried)
        if stack is not None:
            out[w] = stack[0]
        w += 1
    return out


def select(score: dict[int, np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k best rows among the bitmap ``rows``, ties to the first ones; from the most significant slice down."""
    sure, even = np.zeros_like(rows), rows
    if int(np.bitwise_count(rows).sum()) > k:
        for w in sorted(score, reverse=True):
            ones = even & score[w]
            n = int(np.bitwise_count(sure).sum()) + int(np.bitwise_count(ones).sum())
            if n > k:
                even = ones
            else:
                sure = sure | ones
                even = even & ~score[w]
                if n == k:
                    break
    first = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    tied = np.flatnonzero(np.unpackbits(even.view(np.uint8), bitorder="little"))
    return np.concatenate([first, tied[: k - len(first)]])


def search_block(ids: np.ndarray, low: np.ndarray, slices: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query number, row ids, scores) of the k best rows of a block for each query, without the rows with the query's own id."""
    dim, bits, words = slices.shape
    both = np.stack([slices, ~slices])
    full = np.zeros(words * 64, bool)
    full[: len(ids)] = True
    every = np.packbits(full, bitorder="little").view(np.uint64)
    top = (1 << bits) - 1
    for n, (own, q) in enumerate(zip(query_ids, queries, strict=True)):
        size, sign = np.abs(q), (q < 0).astype(np.int64)
        planes: dict[int, list[np.ndarray]] = {}
        for j in range(int(size.max()).bit_length()):
            at = np.flatnonzero((size >> j) & 1)
            if len(at):
                taken = both[sign[at], at]
                for i in range(bits):
                    planes.setdefault(i + j, []).append(taken[:, i])
        score = add_planes(planes)
        rows = every
        lo, hi = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        if hi > lo:
            keep = full.copy()
            keep[lo:hi] = False
            rows = np.packbits(keep, bitorder="little").view(np.uint64)
        best = select(score, rows, k)
        total = np.full(len(best), int((q * low).sum()) - top * int(size[sign == 1].sum()), np.int64)
        for w, plane in score.items():
            total += ((plane[best >> 6] >> (best & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << w
        yield n, ids[best], total


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector: str = "embedding", block: int = BLOCK, chunk: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query with all rows but those of its own id.

    Components become floor(scale * x). Vectors that are null, empty or hold a null or non-finite component, and rows
    without id, take no part; a query meets the rows of its own dimension only. Ties go to the smaller id. Repeated rows are candidates as often
    as they occur, repeated queries count once. If there are fewer than k candidates, all are returned; empty tables give none. Integers and scores must fit 63 bits.
    Without ``chunk`` the chunks are as large as CHUNK, or smaller so that all cores have blocks and chunks that meet.
    """
    spark = rows.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "bsi")
    dim = F.size("q").cast("long")
    base = scratch.save(quantised(rows, id_col, vector, scale), "rows")
    asked = scratch.save(quantised(queries, id_col, vector, scale).dropDuplicates(), "queries")
    n_rows, n_asked = base.count(), asked.count()
    blocks = max(1, -(-n_rows // block))
    chunk = chunk or min(CHUNK, max(64, -(-n_asked * blocks // (2 * spark.sparkContext.defaultParallelism))))
    chunks = max(1, -(-n_asked // chunk))
    # dealt by number, as rows that are alike would all fall into one block
    index = base.groupBy(F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("block"), dim.alias("dim")).applyInArrow(pack_rows, "block long, dim long, ids binary, low binary, bits long, slices binary")
    index = scratch.save(index, "index")
    packed = asked.groupBy(F.pmod(F.xxhash64("id", "q"), F.lit(chunks)).alias("chunk"), dim.alias("dim")).applyInArrow(pack_queries, "chunk long, dim long, query_ids binary, width long, queries binary")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, low = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["low"], np.int64)
                slices = np.frombuffer(r["slices"], np.uint64).reshape(r["dim"], r["bits"], -1)
                asking, queries = np.frombuffer(r["query_ids"], np.int64), np.frombuffer(r["queries"], f"<i{r['width']}").astype(np.int64).reshape(-1, r["dim"])
                found = list(search_block(ids, low, slices, asking, queries, k))
                n = np.concatenate([np.full(len(i), n) for n, i, _ in found])
                cols = [r["chunk"] * np.ones(len(n), np.int64), n, asking[n], np.concatenate([i for _, i, _ in found]), np.concatenate([s for _, _, s in found])]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["chunk", "n", "query_id", "vec_id", "score"])

    met = on_a_grid(index, packed, blocks, chunks, n_rows / max(1, n_asked), ("dim",))
    found = met.mapInArrow(thrifty(run), "chunk long, n long, query_id long, vec_id long, score long")
    best = Window.partitionBy("chunk", "query_id", "n").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
