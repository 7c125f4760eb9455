"""Near-duplicate removal by MinHash with sequential Bayesian verification.

Documents with equal shingle sets form a class, and all else concerns classes. Signatures are cut into bands; classes
with an equal band meet in a bucket. A bucket's members are first compared with its smallest class. Where the others
are then still of different components, they are compared in blocks of bounded size, each block returning no more links than it
has members; pairs of one component are left out. So no component misses a link that any pair of a bucket could
give, and no pairs of a group are written out. A comparison reads the signatures in batches and gives up once the
posterior probability of a similarity at or over the threshold falls below the chosen miss probability; what
survives is verified exactly on the full shingle sets.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import Scratch, shuffle_partitions, small_batches, thrifty
from quizloom.llm.components import components
from quizloom.llm.words import WordHashes, mixed, shingle_set

BANDS, ROWS, BATCH = 32, 5, 32
#: The filter that keeps texts outside any surviving pair from being sent has about so many bits for each wanted id, and so many in all at most (4 MB); more ids are joined.
BITS_AN_ID, FILTER_BITS = 16, 1 << 25
#: Rows of a bucket that fills a task are dealt to so many.
SALTS = 16
#: Members of a block, about: of a bucket's largest component, and of its other ones.
LARGE, SMALL = 512, 256


def signer(seed: int = 5):
    """set of hashes -> signature, 16 bits of the least of each of BANDS * ROWS multiply-add hashes."""
    a, b = np.random.default_rng(seed).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64)
    a = a * np.uint64(2) + np.uint64(1)

    def sign(x: np.ndarray) -> np.ndarray:
        least = [(a[:, None] * x[k : k + 4096] + b[:, None]).min(1) for k in range(0, len(x), 4096)]
        least = reduce(np.minimum, least)
        return (mixed(least) >> np.uint64(48)).astype(np.uint16)

    return sign


def least_matches(threshold: float, miss: float) -> list[int]:
    """The matches that the first 32, 64, ... hashes need at least.

    With a uniform prior, m matches of n leave P(similarity >= t) = P(Binomial(n + 1, t) <= m); a pair goes where that is below ``miss``.
    """
    out = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """id, n_shingles, digest (of the shingle set), signature; the last two null without words."""

    def run(batches):
        known, sign = WordHashes(), signer()
        for batch in batches:
            sets = [shingle_set(t, size, known) for t in batch.column("text").to_pylist()]
            n = pa.array([len(s) for s in sets], pa.int64())
            digest = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary())
            signature = pa.array([sign(s).tobytes() if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), n, digest, signature], ["id", "n_shingles", "digest", "signature"])

    return docs.mapInArrow(thrifty(run), "id long, n_shingles long, digest binary, signature binary")


def buckets(classes: DataFrame) -> DataFrame:
    """bucket, cls, n: a row for each class and band."""

    def run(batches):
        places = np.arange(BANDS, dtype=np.uint64)[None, :]
        for batch in batches:
            m = batch.num_rows
            sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(m, BANDS, ROWS).astype(np.uint64)
            h = np.repeat(places, m, 0) + np.uint64(1)
            for k in range(ROWS):
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
            yield pa.RecordBatch.from_arrays([pa.array(h.reshape(-1).view(np.int64)), *[pa.array(np.repeat(batch.column(c).to_numpy(), BANDS)) for c in ("cls", "n")]], ["bucket", "cls", "n"])

    return classes.select("cls", F.col("n_shingles").alias("n"), "signature").mapInArrow(thrifty(run), "bucket long, cls long, n long")


class Verifier:
    """Tests pairs of classes: by signature, then exactly."""

    def __init__(self, docs: DataFrame, classes: DataFrame, scratch: Scratch, size: int, percent: int, miss: float):
        self.docs, self.classes, self.scratch, self.size, self.percent = docs, classes, scratch, size, percent
        self.least = least_matches(percent / 100, miss)

    def survivors(self, pairs: DataFrame) -> DataFrame:
        least = self.least

        def run(batches):
            for batch in batches:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1, BATCH) for c in ("sa", "sb"))
                alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
                for k, need in enumerate(least):
                    matches[alive] += (x[alive, k] == y[alive, k]).sum(1)
                    alive = alive[matches[alive] >= need]
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in ("a", "b")], ["a", "b"])

        sig = self.classes.select("cls", "signature")
        both = pairs.join(sig.toDF("b", "sb"), "b").join(sig.toDF("a", "sa"), "a")
        return both.mapInArrow(thrifty(run), "a long, b long")

    def texts(self, needed: DataFrame, tag: str) -> DataFrame:
        """cls, packed: the compressed text of one document of each class in ``needed``."""
        size = self.size
        spark = needed.sparkSession
        needed = self.scratch.save(needed.select("cls").distinct().join(self.classes.select("cls", "id", "digest"), "cls"), f"needed-{tag}")
        count = needed.count()
        size_of = min(FILTER_BITS, max(1 << 16, 1 << (BITS_AN_ID * count).bit_length()))
        slot = F.pmod(F.xxhash64("id"), F.lit(size_of))
        docs = self.docs
        wanted = np.full(size_of // 8, 255, np.uint8)
        if BITS_AN_ID * count <= FILTER_BITS:
            wanted[:] = 0
            maps = needed.select((slot + 1).alias("s")).groupBy(F.bitmap_bucket_number("s").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
            for r in maps.toLocalIterator():  # at most FILTER_BITS / 32768 rows of 4 KB
                part = wanted[(r.k - 1) * 4096 : r.k * 4096]
                part |= np.frombuffer(bytes(r.bits), np.uint8)[: len(part)]
        else:
            ids = needed.select(F.col("id").alias("wanted")).distinct()
            docs = docs.join(ids, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
        shared = spark.sparkContext.broadcast(wanted)

        def run(batches):
            known, bits, pack = WordHashes(), shared.value, zstandard.ZstdCompressor(3).compress
            for batch in batches:
                slots = batch.column("slot").to_numpy()
                at = np.flatnonzero((bits[slots >> 3] >> (slots & 7)) & 1)
                part = batch.take(pa.array(at))
                texts = part.column("text").to_pylist()
                digests = [hashlib.blake2b(shingle_set(t, size, known).tobytes(), digest_size=16).digest() for t in texts]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(digests, pa.binary()), pa.array([pack((t or "").encode("utf-8", "surrogatepass")) for t in texts], pa.binary())], ["id", "digest", "packed"])

        found = docs.select("id", "text", slot.alias("slot")).mapInArrow(thrifty(run), "id long, digest binary, packed binary")
        same = (F.col("n.digest") == F.col("f.digest")) & F.col("n.id").eqNullSafe(F.col("f.id"))
        one = needed.alias("n").join(found.alias("f"), same).select("cls", "packed")
        return self.scratch.save(one.dropDuplicates(["cls"]), f"texts-{tag}")

    def linked(self, pairs: DataFrame, tag: str) -> DataFrame:
        """The pairs (a, b) whose similarity reaches the threshold; written to the scratch folder."""
        left = self.scratch.save(self.survivors(pairs), f"survivors-{tag}")
        texts = self.texts(left.select(F.col("a").alias("cls")).union(left.select(F.col("b").alias("cls"))), tag)
        size, percent = self.size, self.percent

        def run(batches):
            known, unpack = WordHashes(), zstandard.ZstdDecompressor().decompress
            last, center = None, None
            for batch in batches:
                keep = []
                for k, (a, pa_, pb) in enumerate(zip(batch.column("a").to_pylist(), batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True)):
                    if a != last:
                        last, center = a, shingle_set(unpack(pa_).decode("utf-8", "surrogatepass"), size, known)
                    other = shingle_set(unpack(pb).decode("utf-8", "surrogatepass"), size, known)
                    both = len(np.intersect1d(center, other, assume_unique=True))
                    if 100 * both >= percent * (len(center) + len(other) - both):
                        keep.append(k)
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], ["a", "b"])

        both = left.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a")
        out = self.scratch.save(both.mapInArrow(thrifty(run), "a long, b long"), f"linked-{tag}")
        self.scratch.drop(f"survivors-{tag}", f"needed-{tag}", f"texts-{tag}")
        return out

    def links_in_blocks(self, mixed_: DataFrame, limit: int, tag: str) -> DataFrame:
        """Links (a, b) between members of different roots in the same bucket, as many as join them; written to the scratch folder.

        ``mixed_``: bucket, size, cls, n, root. The members of a bucket's largest component meet all others, these also each other. First only
        signatures meet; the texts of those that are likely to be linked in a block follow.
        """
        counts = mixed_.groupBy("bucket", "root").agg(F.count("*").alias("k"), F.max("size").alias("size"))
        per = counts.groupBy("bucket").agg(F.sum("k").alias("rows"), F.max("size").alias("size"), F.max(F.struct("k", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1")
        small = F.ceil((F.col("rows") - F.col("top.k")) / SMALL).cast("int")
        per = per.select("bucket", "size", F.col("top.root").alias("top"), small.alias("ns"), F.ceil(F.col("top.k") / LARGE).cast("int").alias("nl"))
        rows = by_bucket(mixed_, per, limit).withColumn("large", F.col("root") == F.col("top"))
        rows = rows.withColumn("own", F.pmod(F.xxhash64("cls"), F.when(F.col("large"), F.col("nl")).otherwise(F.col("ns"))).cast("int"))
        each = F.sequence(F.lit(0), F.col("ns") - 1)
        with_small = F.transform(each, lambda j: F.struct(F.lit("s").alias("kind"), F.least("own", j).alias("x"), F.greatest("own", j).alias("y")))
        with_large = F.transform(F.sequence(F.lit(0), F.col("nl") - 1), lambda j: F.struct(F.lit("l").alias("kind"), F.col("own").alias("x"), j.alias("y")))
        as_large = F.transform(each, lambda i: F.struct(F.lit("l").alias("kind"), i.alias("x"), F.col("own").alias("y")))
        rows = rows.select("bucket", "cls", "root", F.explode(F.when(F.col("large"), as_large).otherwise(F.concat(with_small, with_large))).alias("at"))
        rows = rows.join(self.classes.select("cls", F.col("n_shingles").alias("n"), "signature"), "cls").select("bucket", "at.kind", "at.x", "at.y", "cls", "root", "n", "signature")
        least, size, percent = self.least, self.size, self.percent

        def signatures(group) -> np.ndarray:
            return np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint16).reshape(group.num_rows, -1, BATCH)

        def meet(key, group):
            x, y = likely_pairs(group["n"].to_numpy(), signatures(group), group["root"].to_numpy(), least, percent)
            return group.take(pa.array(np.union1d(x, y)))

        def compare(key, group):
            cls, unpack = group["cls"].to_numpy(), zstandard.ZstdDecompressor().decompress
            sets = [shingle_set(unpack(t).decode("utf-8", "surrogatepass"), size, WORDS) for t in group["packed"].to_pylist()]
            tree = spanning_links(sets, signatures(group), group["root"].to_numpy(), least, percent)
            return pa.table({"a": pa.array([min(cls[i], cls[j]) for i, j in tree], pa.int64()), "b": pa.array([max(cls[i], cls[j]) for i, j in tree], pa.int64())})

        block = ["bucket", "kind", "x", "y"]
        likely = rows.groupBy(*block).applyInArrow(meet, "bucket long, kind string, x int, y int, cls long, root long, n long, signature binary")
        likely = self.scratch.save(likely, f"likely-{tag}")
        texts = self.texts(likely, f"blocks-{tag}")
        found = likely.join(texts, "cls").groupBy(*block).applyInArrow(compare, "a long, b long")
        found = self.scratch.save(found, f"linked-{tag}")
        self.scratch.drop(f"likely-{tag}", f"needed-blocks-{tag}", f"texts-blocks-{tag}")
        return found


def by_bucket(rows: DataFrame, one: DataFrame, limit: int) -> DataFrame:
    """``rows`` joined to the row of ``one`` with their bucket; both know its size, and a bucket over ``limit`` is dealt to SALTS tasks."""
    own = F.when(F.col("size") > limit, F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int")).otherwise(0)
    every = F.when(F.col("size") > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("salt", own).join(one.withColumn("salt", F.explode(every)).drop("size"), ["bucket", "salt"]).drop("salt")


#: Of the block tasks of a worker.
WORDS = WordHashes()


def likely_pairs(n: np.ndarray, sig: np.ndarray, root: np.ndarray, least: list[int], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different roots that neither their sizes nor batch after batch of their signatures rule out."""
    x, y = np.nonzero(np.triu(root[:, None] != root[None, :]) & (100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])))
    matches = np.zeros(len(x), np.int64)
    for k, need in enumerate(least):
        for at in range(0, len(x), 1 << 16):
            part = slice(at, at + (1 << 16))
            matches[part] += (sig[x[part], k] == sig[y[part], k]).sum(1)
        alive = matches >= need
        x, y, matches = x[alive], y[alive], matches[alive]
    return x, y


def spanning_links(sets: list[np.ndarray], sig: np.ndarray, root: np.ndarray, least: list[int], percent: int) -> list[tuple[int, int]]:
    """Enough links between sets of different roots to join all that links join."""
    n = np.array([len(s) for s in sets], np.int64)
    x, y = likely_pairs(n, sig, root, least, percent)
    if not len(x):
        return []
    # exact: the shingles that two sets or more have, as bitmaps
    every = np.concatenate(sets)
    values, place, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    bits = np.zeros((len(sets), -(-int((count > 1).sum() + 1) // 64) * 64), bool)
    owner, common = np.repeat(np.arange(len(sets)), n), count[place] > 1
    bits[owner[common], shared[place[common]]] = True
    words = np.packbits(bits, 1).view(np.uint64)
    linked = np.zeros((len(sets), len(sets)), bool)
    step = max(1, (1 << 20) // words.shape[1])
    for at in range(0, len(x), step):
        i, j = x[at : at + step], y[at : at + step]
        both = np.bitwise_count(words[i] & words[j]).sum(1, dtype=np.int64)
        good = 100 * both >= percent * (n[i] + n[j] - both)
        linked[i[good], j[good]] = linked[j[good], i[good]] = True
    tree, todo = [], np.ones(len(sets), bool)
    for start in range(len(sets)):
        edge = [start] if todo[start] else []
        todo[start] = False
        while edge:
            i = edge.pop()
            new = np.flatnonzero(linked[i] & todo)
            todo[new] = False
            tree += [(i, int(j)) for j in new]
            edge += new.tolist()
    return tree


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80, miss: float = 1e-6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id, kept for each row of ``docs``.

    Texts with intersection / union >= percent / 100 of their distinct ``size``-word shingles are linked; component_id is the smallest key
    that links reach, kept whether it is the row's own. A text with fewer words is one shingle; null texts and texts without words have none, and are linked with nothing. Null keys are
    no component's smallest, unless it has no other. Rows with equal keys share the answer as far as their texts are linked. An empty table gives none. Other columns are not read.
    Keys are integers; a text that is none is an error.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "minhash")
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = scratch.save(sketches(docs, size), "rows")
    worded = rows.where("digest IS NOT NULL")
    first = worded.groupBy("digest").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = scratch.save(first.withColumn("cls", F.monotonically_increasing_id()), "classes")

    every = buckets(classes)
    full = every.groupBy("bucket").agg(F.min(F.struct("cls", "n")).alias("centre"), F.count("*").alias("size")).where("size > 1")
    full = scratch.save(full, "buckets")
    # a bucket with more rows than a quarter of a task's share is dealt to several tasks; there are at most four for each task
    limit = max(256, BANDS * classes.count() // (4 * shuffle_partitions(spark)))
    hot = full.where(F.col("size") > limit).select("bucket", "size")
    sized = every.join(F.broadcast(hot), "bucket", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    members = scratch.save(by_bucket(sized, full.withColumn("all", F.col("size")), limit).drop("size").withColumnRenamed("all", "size"), "members")
    # most classes share no bucket; the others' signatures are a small table of their own
    met = scratch.save(classes.join(members.select("cls").distinct(), "cls", "left_semi"), "met")
    verifier = Verifier(docs, met, scratch, size, percent, miss)
    near = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
    pairs = members.select(F.col("centre.cls").alias("a"), F.col("centre.n").alias("na"), F.col("cls").alias("b"), F.col("n").alias("nb"))
    links = verifier.linked(scratch.save(pairs.where(f"a <> b AND {near}").select("a", "b").distinct(), "pairs"), "0")
    roots = components(links, scratch, "cc-0")
    # the smallest class of a bucket has met all others; these have not met each other
    others = members.where("size > 2 AND cls <> centre.cls").select("bucket", "cls", "n", "size")

    def still_mixed(tag: str) -> DataFrame:
        rooted = others.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        several = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("size").alias("size")).where("lo <> hi").select("bucket", "size")
        return scratch.save(by_bucket(rooted, several, limit), tag)

    mixed_ = still_mixed("mixed-1")
    # first each class in its largest bucket only, which joins most of a group of near copies, then what is left everywhere
    largest = mixed_.groupBy("cls").agg(F.max(F.struct("size", "bucket")).alias("m")).select("cls", F.col("m.bucket").alias("bucket"))
    joined = components(verifier.links_in_blocks(mixed_.join(largest, ["cls", "bucket"]), limit, "1"), scratch, "cc-1", roots)
    if joined is not roots:
        roots = joined
        mixed_ = still_mixed("mixed-2")
    roots = components(verifier.links_in_blocks(mixed_, limit, "2"), scratch, "cc-2", roots)
    found = classes.select("cls", "id", "digest").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    found = scratch.save(found.select("id", "digest", "root"), "found")
    least = found.groupBy("root").agg(F.min("id").alias("component_id"))
    named = scratch.save(found.join(least, "root").select("digest", "component_id"), "named")
    scratch.drop("classes", "met", "buckets", "members", "pairs", "mixed-1", "mixed-2", "found")
    out = rows.select("id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
