"""Document fingerprints as invertible Bloom lookup sketches, with DataFrame functions only.

A text is the multiset of its paragraphs: lines, cut into pieces at places that depend on the letters there, as many texts
are one line; repeated ones are told apart by their number. Each has a 64-bit digest that carries a 16-bit check of itself and goes into one
cell of each of three parts of a table. The published sketch has 24 cells, each with a count and the XOR of its digests.

Two versions are compared by subtracting their sketches and peeling: a cell with one valid digest gives it away, and removing it
from its other two cells uncovers more. If cells are left over, the digests are dealt to many tables by ranges of their values, as
many as even texts without a common paragraph need; of these it takes only the XORs. A table that fails is built
again with more cells and other hashes. Everything of a pair is done in its row: nothing but the texts and their hashes is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizloom.llm.common import shuffle_partitions

#: Cells of each of the three parts of the published sketch.
PART = 8
#: Digests of both texts that one of many tables gets on average, its cells a part, and those of the tables that failed ones are built again as.
LOAD, SMALL, LARGER = 3, 4, (8, 32, 128, 512)
ROUNDS = 12
#: Characters that a range of neighbouring rows holds about, where there are not more ranges than MOST_RANGES.
RANGE_CHARS, MOST_RANGES = 512_000_000, 20_000
CHECK = 1 << 16
#: Letters and digits of odd places. A piece ends at a line's end, and between two words whose last and first two letters are such: one in sixteen of even use.
ODD = "acegikmoqsuwyACEGIKMOQSUWY13579"
CUT = rf"[\r\n]+|(?<=[{ODD}][{ODD}])[ \t]+(?=[{ODD}][{ODD}])"
#: Characters of a piece at most; longer ones are cut from their start on.
LONGEST = 160


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def nothing() -> Column:
    return F.array().cast("array<bigint>")


def pieces(text: Column) -> Column:
    """The pieces of a text but those of blanks."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), CUT), lambda p: F.trim(p) != "")
    return let(parts, lambda ps: F.when(F.exists(ps, lambda p: F.length(p) > LONGEST), F.flatten(F.transform(ps, lambda p: F.regexp_extract_all(p, F.lit(f"(?s).{{1,{LONGEST}}}"), F.lit(0))))).otherwise(ps))


def digests(text: Column) -> Column:
    """Distinct digests of the pieces of a text; where a piece occurs again, its number is hashed in. Null texts and those of white space have none."""

    def numbered(h: Column) -> Column:
        """Of each run of equal hashes the first as it is, the others with their number."""
        starts = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: (i == 0) | (F.get(h, i) != F.get(h, i - 1)))
        return let(starts, lambda s: F.flatten(F.zip_with(s, F.concat(F.slice(s, 2, F.size(s)), F.array(F.size(h))), lambda a, b: F.transform(
            F.sequence(a, b - 1), lambda i: F.when(i == a, F.get(h, i)).otherwise(F.xxhash64(F.get(h, i), i - a))))))

    found = F.transform(pieces(text), lambda p: F.xxhash64(p))
    found = let(found, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), h).otherwise(let(F.sort_array(h), numbered)))
    return F.array_distinct(F.transform(found, digest))


def digest(h: Column) -> Column:
    """The hash with its last 16 bits replaced by a check of the others."""
    top = h - F.pmod(h, F.lit(CHECK))
    return top + F.pmod(F.xxhash64(top), F.lit(CHECK))


def valid(e: Column) -> Column:
    return F.pmod(e, F.lit(CHECK)) == F.pmod(F.xxhash64(e - F.pmod(e, F.lit(CHECK))), F.lit(CHECK))


def places(e: Column, part: int, seed: int) -> Column:
    """The cells of a digest, one in each part."""
    return let(F.xxhash64(e, F.lit(seed)), lambda r: F.array(*[(F.shiftright(r, 20 * s).bitwiseAND(F.lit(part - 1)) + s * part).cast("int") for s in range(3)]))


def sketch(elements: Column) -> Column:
    """array<struct<c, x>>: the cells of the published table."""
    placed = F.transform(elements, lambda e: F.struct(e.alias("e"), places(e, PART, 1).alias("at")))
    empty = F.struct(F.lit(0).alias("c"), F.lit(0).cast("long").alias("x"))
    return let(placed, lambda ps: F.transform(F.sequence(F.lit(0), F.lit(3 * PART - 1)), lambda j: F.aggregate(
        F.filter(ps, lambda p: F.array_contains(p["at"], j)), empty, lambda a, p: F.struct((a["c"] + 1).alias("c"), a["x"].bitwiseXOR(p["e"]).alias("x")))))


def peeled(a: Column, b: Column) -> Column:
    """The digests that the sketches a and b differ in; null if cells are left over."""
    cells = F.zip_with(a, b, lambda x, y: F.struct((x["c"] - y["c"]).alias("c"), x["x"].bitwiseXOR(y["x"]).alias("x")))

    def pure(cells: Column) -> Column:
        found = F.filter(cells, lambda c: (F.abs(c["c"]) == 1) & valid(c["x"]))
        return F.array_distinct(F.transform(found, lambda p: F.struct(p["x"].alias("e"), p["c"].alias("c"), places(p["x"], PART, 1).alias("at"))))

    def step(s: Column) -> Column:
        def less(ps: Column) -> Column:
            after = F.transform(s["cells"], lambda c, j: F.aggregate(F.filter(ps, lambda p: F.array_contains(p["at"], j)), c, lambda m, p: F.struct((m["c"] - p["c"]).alias("c"), m["x"].bitwiseXOR(p["e"]).alias("x"))))
            got = F.concat(s["got"], F.transform(ps, lambda p: p["e"]))
            return F.when(F.size(ps) == 0, F.struct(s["cells"].alias("cells"), s["got"].alias("got"), F.lit(False).alias("go"))).otherwise(F.struct(after.alias("cells"), got.alias("got"), F.lit(True).alias("go")))

        return F.when(s["go"], let(pure(s["cells"]), less)).otherwise(s)

    start = F.struct(cells.alias("cells"), nothing().alias("got"), F.lit(True).alias("go"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, _: step(s))
    return let(done, lambda s: F.when(F.forall(s["cells"], lambda c: (c["c"] == 0) & (c["x"] == 0)), s["got"]))


def unravelled(elements: Column, part: int, seed: int | None) -> Column:
    """The digests that occur once in ``elements`` by peeling a table of XORs with ``part`` cells a part; null if cells are left over.

    Digests of both texts cancel each other. Without ``seed``, bits of the digest name its cells. A round takes all valid cells at once.
    """
    width = part.bit_length() - 1
    shifts = [16, 16 + width, 16 + 2 * width] if seed is None else [0, 20, 40]
    cells = F.lit([v << shift for shift in shifts for v in range(part)])
    masks = F.lit([(part - 1) << shift for shift in shifts for _ in range(part)])

    def bits(e: Column) -> Column:
        return e if seed is None else F.xxhash64(e, F.lit(seed))

    def folded(into: Column, these: Column) -> Column:
        """``into`` with these digests in their cells."""
        known = F.transform(these, lambda e: F.struct(e.alias("e"), bits(e).alias("r")))
        fold = lambda x, m, v, es: F.aggregate(es, x, lambda acc, p: F.when(p["r"].bitwiseAND(m) == v, acc.bitwiseXOR(p["e"])).otherwise(acc))
        both = F.arrays_zip(into.alias("x"), masks.alias("m"), cells.alias("v"))
        return let(known, lambda es: F.transform(both, lambda z: fold(z["x"], z["m"], z["v"], es)))

    def total(these: Column) -> Column:
        return F.aggregate(these, F.lit(0).cast("long"), lambda x, e: x.bitwiseXOR(e))

    def step(s: Column) -> Column:
        """If the sum of the valid cells is that of a whole part, nothing else is in the table."""
        found = F.array_distinct(F.filter(s["cells"], lambda x: (x != 0) & valid(x)))
        return F.when(s["go"], let(found, lambda q: F.when(total(q) == s["rest"], state(s["cells"], s["got"], q, F.lit(0).cast("long"), F.lit(False))).when(
            F.size(q) == 0, state(s["cells"], s["got"], q, s["rest"], F.lit(False))).otherwise(
            state(folded(s["cells"], q), s["got"], q, s["rest"].bitwiseXOR(total(q)), F.lit(True))))).otherwise(s)

    def state(cells: Column, got: Column, more: Column, rest: Column, go: Column) -> Column:
        return F.struct(cells.alias("cells"), F.concat(got, more).alias("got"), rest.alias("rest"), go.alias("go"))

    start = state(folded(F.array_repeat(F.lit(0).cast("long"), 3 * part), elements), nothing(), nothing(), total(elements), F.lit(True))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, _: step(s))
    return let(done, lambda s: F.when((s["rest"] == 0) & ~s["go"] & sound(s["got"], elements), s["got"]))


def sound(got: Column, elements: Column) -> Column:
    """No digest was taken twice, or taken for one by chance: one sum of several in 65,536 passes the check."""
    return (F.size(F.array_distinct(got)) == F.size(got)) & (F.size(F.array_except(got, elements)) == 0)


def dealt(elements: Column, tables: Column) -> Column:
    """array<array<long>>: sorted digests by ``tables`` equal ranges of their values, those with digests."""
    places = F.transform(elements, lambda e: F.floor((e.cast("double") / 2.0**64 + 0.5) * tables))
    starts = let(places, lambda p: F.filter(F.sequence(F.lit(1), F.size(p)), lambda i: (i == 1) | (F.get(p, i - 1) != F.get(p, i - 2))))
    slices = let(starts, lambda a: F.zip_with(a, F.concat(F.slice(a, 2, F.size(a)), F.array(F.size(elements) + 1)), lambda i, j: F.slice(elements, i, j - i)))
    return F.when(F.size(elements) == 0, F.array().cast("array<array<bigint>>")).otherwise(slices)


def difference(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """The digests that only a or only b has: by the two sketches, else by as many tables as it takes."""

    def one(these: Column) -> Column:
        tries = [unravelled(these, SMALL, None), *[unravelled(these, part, seed + 2) for seed, part in enumerate(LARGER)]]
        return F.coalesce(*tries, F.raise_error(F.lit("a table of digests could not be peeled")).cast("array<bigint>"))

    tables = F.ceil((F.size(a) + F.size(b)) / LOAD).cast("int")
    whole = let(peeled(sketch_a, sketch_b), lambda got: F.when(sound(got, F.concat(a, b)), got))
    return F.coalesce(whole, let(F.sort_array(F.concat(a, b)), lambda e: F.flatten(F.transform(dealt(e, tables), one))))


def likeness(a: Column, b: Column, d: Column) -> Column:
    """Common pieces in all pieces of both, of which ``d`` differ; 1 if neither text has any."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - d) / (both + d))


def written(cells: Column, n: Column) -> Column:
    return F.concat_ws(":", F.hex(n), F.array_join(F.transform(cells, lambda c: F.concat_ws("-", F.hex(c["c"]), F.hex(c["x"]))), "."))


def below(bounds: list[int], x: Column) -> Column:
    """How many of the ascending ``bounds`` are less than x, by binary search."""
    steps = [1 << s for s in reversed(range(len(bounds).bit_length()))]
    known = F.lit(bounds)
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, s: F.when((at + s <= len(bounds)) & (F.try_element_at(known, at + s) < x), at + s).otherwise(at)) if bounds else F.lit(0)


def neighbours(docs: DataFrame, key: str, text: str) -> DataFrame:
    """k, t, a, ta, after, c, tc: each key with its text, the digests and the sketch of that, and the same of the next row.

    The order is descending by key (nulls last, equal keys by text); after the last row comes the first. Rows go to ranges of nearly
    equal size; a key that fills a range, or null, is split by the first bytes of its texts. The first row of each range is a guest at the end of the one
    before, so that one window a range sees every neighbour.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    chars, total, nulls = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)), F.count("*"), F.count_if(F.col("k").isNull())).first()
    n = min(MOST_RANGES, max(4 * shuffle_partitions(spark), -(-chars // RANGE_CHARS)))
    points = [j / n for j in range(1, n)]
    cuts = rows.agg(F.percentile_approx("k", points, 20 * n)).first()[0] or []
    bounds, hot = sorted(set(cuts)), sorted({b for a, b in zip(cuts, cuts[1:], strict=False) if a == b})
    is_hot = F.coalesce(F.col("k").isin(hot), F.lit(nulls * n > total)) if hot else F.col("k").isNull() & F.lit(nulls * n > total)
    start = F.conv(F.rpad(F.hex(F.substring(F.encode("t", "utf-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    inner = sorted(set(rows.where(is_hot).agg(F.percentile_approx(start, points, 20 * n)).first()[0] or [])) if hot or nulls * n > total else []
    # ranges in ascending order of keys; the hot key of a range is its greatest and gets numbers of its own, from its last texts to its first
    at = F.when(F.col("k").isNull(), F.lit(-1)).otherwise(below(bounds, F.col("k"))) * (n + 2)
    rows = rows.withColumn("s", F.when(is_hot, start).otherwise(0))
    rows = rows.withColumn("r", at + F.when(is_hot, 1 + len(inner) - below(inner, F.col("s"))).otherwise(0))
    heads = sorted(map(tuple, rows.groupBy("r").agg(F.max("k"), F.min("s")).collect()), reverse=True)  # a row for each range
    guests = spark.createDataFrame([(k, s, heads[j - 1][0]) for j, (_, k, s) in enumerate(heads)] or [(None, None, None)], "head long, first long, before int")
    rows = rows.withColumn("a", digests(F.col("t")))
    seen = rows.join(F.broadcast(guests), F.col("k").eqNullSafe(F.col("head")) & (F.col("s") == F.col("first")), "left")
    own, as_guest = F.struct("r", F.lit(False).alias("guest")), F.struct(F.col("before").alias("r"), F.lit(True).alias("guest"))
    seen = seen.select("k", "t", "a", F.explode(F.when(F.col("before").isNotNull(), F.array(own, as_guest)).otherwise(F.array(own))).alias("at"))
    seen = seen.repartition("at.r").withColumn("ta", sketch(F.col("a")))
    order = Window.partitionBy("at.r").orderBy("at.guest", F.desc_nulls_last("k"), "t")
    return seen.select("*", *[F.lead(v).over(order).alias(name) for v, name in (("t", "after"), ("a", "c"), ("ta", "tc"))]).where("NOT at.guest").drop("at")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", recovered: bool = False) -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row; with ``recovered`` also removed and added.

    The edited text has its last third (whole code points, rounded down) replaced by as much of the beginning of the next row's text, or all of it. Likeness
    is the share of common pieces in all pieces of both texts; a null text counts as empty, and texts without pieces are like each other. Removed and
    added are the recovered digests that only the text and only its edit have. Repeated rows are each other's next. One row alone is its own next. An empty
    table gives none. Other columns of ``docs`` are not read. Keys are integers; a text that is none is an error.
    """
    rows = neighbours(docs, key, text).withColumn("n_chars", F.length("t").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("t", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("after", F.lit(1), cut)))
    col = F.col
    rows = rows.select("k", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "a", "ta", digests(col("edited")).alias("b"), "c", "tc").withColumn("tb", sketch(col("b")))
    rows = rows.withColumn("d_edited", difference(col("a"), col("b"), col("ta"), col("tb"))).withColumn("d_next", F.size(difference(col("a"), col("c"), col("ta"), col("tc"))))
    lists = [F.sort_array(F.array_intersect("d_edited", v)).alias(name) for v, name in (("a", "removed"), ("b", "added"))] if recovered else []
    return rows.select(
        col("k").alias(key), "n_chars", "edited_sha256", written(col("ta"), F.size("a")).alias("fingerprint"), written(col("tb"), F.size("b")).alias("edited_fingerprint"),
        likeness(col("a"), col("b"), F.size("d_edited")).alias("near_edited"), likeness(col("a"), col("c"), col("d_next")).alias("near_next"), *lists,
    )
