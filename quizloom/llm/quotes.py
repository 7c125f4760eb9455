"""Chat formatting by quotation linking, with DataFrame functions only.

Lines of a message that start with ``>`` quote; the number of marks is the level. Neighbouring lines of one level are a
passage. Passages are normalised and hashed as windows of four words, so that neither a client's line breaks nor a part left out hide them; shorter
ones are hashed whole. A window's origin is the first message of the conversation that has it as its own words, and a passage was
taken from the message where most of its windows come from. Messages get the place behind what they answer, and their text without the quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import Scratch

QUOTE = r"^\s*((?:>[ \t]?)+)"
#: Words of a window.
WORDS = 4
#: Of each key that many rows may point to.
SALTS = 8


def let(value: Column, f) -> Column:
    """f(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def lines(text: Column) -> Column:
    """array<struct<level, body>>: the quote level of each line, 0 for the message's own, and the line without its marks."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r"), lambda s: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(s, QUOTE, 1), r"[^>]", "")).alias("level"), F.regexp_replace(s, QUOTE, "").alias("body")))


def passages(of: Column) -> Column:
    """array<struct<level, bodies>>: runs of neighbouring lines of one level."""
    at = F.filter(F.sequence(F.lit(0), F.size(of) - 1), lambda i: (i == 0) | (F.get(of, i)["level"] != F.get(of, i - 1)["level"]))
    return let(at, lambda a: F.zip_with(a, F.concat(F.slice(a, 2, F.size(a)), F.array(F.size(of))), lambda i, j: F.struct(
        F.get(of, i)["level"].alias("level"), F.transform(F.slice(of, i + 1, j - i), lambda s: s["body"]).alias("bodies"))))


def plain(body: Column) -> Column:
    """Lower case, all but letters and numbers as one space."""
    return F.trim(F.regexp_replace(F.lower(body), r"[^\p{L}\p{N}]+", " "))


def whole_key(text: Column) -> Column:
    return F.xxhash64(F.lit("whole"), text)


def keys(text: Column) -> Column:
    """Distinct hashes of the windows of a normalised text, of a shorter one as a whole; none if nothing is left."""
    windows = let(F.split(text, " "), lambda w: F.when(F.size(w) < WORDS, F.array(whole_key(text))).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - WORDS + 1), lambda k: F.xxhash64(F.array_join(F.slice(w, k, WORDS), " "))))))
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(windows)


def own_keys(passage: Column) -> Column:
    """What a passage of a message's own lines may be quoted by: its windows, and those of its lines that are shorter than one."""
    short = F.filter(F.transform(passage["bodies"], plain), lambda s: (s != "") & (F.size(F.split(s, " ")) < WORDS))
    return F.array_union(keys(plain(F.array_join(passage["bodies"], " "))), F.transform(short, whole_key))


def thread(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", role: str = "role", paths: bool = True) -> DataFrame:
    """The rows of ``messages`` with reply_to (turn of the answered message), quote_levels, root_turn, reply_path, body (the text without quotes) and chat (role and body).

    Without ``paths`` there is reply_depth, the number of messages above, instead of reply_path: in a chain of n replies the paths hold n * n / 2 turns.

    reply_path holds the turns from the thread's first message to this one. Read in the order of conversation and reply_path, a conversation has each message behind what it
    replies to, and its answers next to it. Of the passages whose origin is earlier in the conversation (half of their windows at least), a message replies to
    the one of the lowest level, then with the most windows, then with the latest origin. Messages without such a passage are roots. Null texts give a null body and chat and no
    links, rows without conversation or turn are roots of their own (root_turn is their turn); a null role leaves the body alone. Messages with equal conversation and
    turn share their links. An empty table gives none. Columns of ``messages`` with the names of added ones are replaced.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    messages = messages.drop("reply_to", "quote_levels", "root_turn", "reply_path" if paths else "reply_depth", "body", "chat")
    known = messages.where(F.col(conv).isNotNull() & F.col(turn).isNotNull() & F.col(text).isNotNull()).select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.col(text).alias("text"))
    quoting = known.where(F.col("text").rlike(r"(?m)^\s*>")).select("c", "t", F.explode(passages(lines(F.col("text")))).alias("p")).where("p.level > 0")
    quoting = quoting.select("c", "t", "p.level", plain(F.array_join("p.bodies", " ")).alias("plain")).distinct()
    quoting = quoting.select("c", "t", "level", F.xxhash64("plain").alias("passage"), keys(F.col("plain")).alias("keys"))
    quoted = scratch.save(quoting.select("c", "t", "level", "passage", F.size("keys").alias("n"), F.explode("keys").alias("h")), "quoted")
    # conversations without quotes leave here: their words need no index
    own = known.join(quoted.select("c").distinct(), "c", "left_semi").select("c", "t", F.explode(passages(lines(F.col("text")))).alias("p")).where("p.level = 0")
    own = own.select("c", "t", F.explode(own_keys(F.col("p"))).alias("h"))
    origin = own.join(quoted.select("c", "h").distinct(), ["c", "h"], "left_semi").groupBy("c", "h").agg(F.min("t").alias("o"))
    votes = salted_join(quoted, origin, ["c", "h"], "t", "inner").where("o < t").groupBy("c", "t", "level", "passage", "n", "o").agg(F.count("*").alias("v")).where("2 * v >= n")
    links = votes.groupBy("c", "t").agg(F.max(F.struct(-F.col("level"), "v", "o")).alias("m")).select("c", "t", F.col("m.o").alias("p"))
    links = scratch.save(links, "links")
    roots = scratch.save(links.select("c", "t", F.col("p").alias("r"), (F.array("t") if paths else F.lit(1)).alias("path")), "roots-0")
    step, open_ends = 0, links.limit(1).count()
    joined = F.concat("before", "path") if paths else F.col("before") + F.col("path")
    while open_ends:  # pointer jumping: a chain of n replies takes log2(n) rounds
        up = roots.select("c", F.col("t").alias("r"), F.col("r").alias("up"), F.col("path").alias("before"))
        moved = salted_join(roots, up, ["c", "r"], "t", "left")
        moved = moved.select("c", "t", F.coalesce("up", "r").alias("r"), F.when(F.col("up").isNotNull(), joined).otherwise(F.col("path")).alias("path"), F.col("up").isNotNull().alias("moved"))
        moved = scratch.save(moved, f"roots-{step + 1}")
        open_ends = moved.where("moved").limit(1).count()
        scratch.drop(f"roots-{step}")
        roots, step = moved.select("c", "t", "r", "path"), step + 1
    found = links.join(roots, ["c", "t"]).select(F.col("c").alias("__c"), F.col("t").alias("__t"), F.col("p").alias("reply_to"), F.col("r").alias("__root"), (F.concat(F.array("r"), "path") if paths else F.col("path")).alias("__path"))
    out = messages.join(found, (F.col(conv) == F.col("__c")) & (F.col(turn) == F.col("__t")), "left")
    split = lines(F.col(text))
    own_text = F.array_join(F.transform(F.filter(split, lambda s: s["level"] == 0), lambda s: s["body"]), "\n")
    out = out.withColumn("quote_levels", F.coalesce(F.array_max(F.transform(split, lambda s: s["level"])), F.lit(0)))
    out = out.withColumn("root_turn", F.coalesce("__root", F.col(turn))).withColumn("reply_path" if paths else "reply_depth", F.coalesce("__path", F.array(turn) if paths else F.lit(0))).withColumn("body", F.when(F.col(text).isNotNull(), F.trim(own_text)))
    return out.withColumn("chat", F.when(F.col("body").isNotNull(), F.concat_ws(": ", F.col(role), "body"))).drop("__c", "__t", "__root", "__path")


def salted_join(many: DataFrame, one: DataFrame, on: list[str], by: str, how: str) -> DataFrame:
    """``many`` joined to the only row of ``one`` with its key; a key of very many rows is dealt to SALTS tasks by ``by``."""
    left = many.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    right = one.withColumn("__salt", F.explode(F.lit(list(range(SALTS))).cast("array<bigint>")))
    return left.join(right, [*on, "__salt"], how).drop("__salt")


QUOTES_SQL = r"""
WITH m AS (SELECT *, row_number() OVER () AS rowid_ FROM conversations),
line AS (SELECT rowid_, conv_id, turn, i, length(regexp_replace(regexp_extract(s, '^\s*((?:>[ \t]?)+)', 1), '[^>]', '', 'g')) AS level, regexp_replace(s, '^\s*((?:>[ \t]?)+)', '') AS body
         FROM (SELECT *, unnest(lines) AS s, generate_subscripts(lines, 1) AS i FROM (SELECT *, regexp_split_to_array(coalesce(text, ''), '\r\n|\n|\r') AS lines FROM m))),
edge AS (SELECT *, CASE WHEN lag(level) OVER (PARTITION BY rowid_ ORDER BY i) IS DISTINCT FROM level THEN 1 ELSE 0 END AS new FROM line),
run AS (SELECT *, sum(new) OVER (PARTITION BY rowid_ ORDER BY i) AS run, trim(regexp_replace(lower(body), '[^\p{L}\p{N}]+', ' ', 'g')) AS line_plain FROM edge),
passage AS (SELECT conv_id, turn, level, trim(regexp_replace(lower(string_agg(body, ' ' ORDER BY i)), '[^\p{L}\p{N}]+', ' ', 'g')) AS plain
            FROM run WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY rowid_, conv_id, turn, run, level),
key AS (SELECT DISTINCT conv_id, turn, level, plain, unnest(CASE WHEN plain = '' THEN [] WHEN len(w) < 4 THEN ['whole ' || plain]
               ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k+3], ' '))) END) AS h FROM (SELECT *, string_split(plain, ' ') AS w FROM passage)),
own AS (SELECT conv_id, turn, h FROM key WHERE level = 0
        UNION ALL SELECT conv_id, turn, 'whole ' || line_plain FROM run WHERE level = 0 AND line_plain <> '' AND len(string_split(line_plain, ' ')) < 4),
origin AS (SELECT conv_id, h, min(turn) AS o FROM own GROUP BY ALL),
quoted AS (SELECT *, count(*) OVER (PARTITION BY conv_id, turn, level, plain) AS n FROM key WHERE level > 0),
vote AS (SELECT conv_id, turn, level, plain, o, count(*) AS v FROM quoted JOIN origin USING (conv_id, h) WHERE o < turn GROUP BY conv_id, turn, level, plain, n, o HAVING 2 * count(*) >= n),
link AS (SELECT conv_id, turn, max({'l': -level, 'v': v, 'o': o}).o AS p FROM vote GROUP BY ALL),
own_text AS (SELECT rowid_, max(level) AS quote_levels, trim(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0), ''), ' ') AS body FROM line GROUP BY rowid_),
chain AS (WITH RECURSIVE up AS (SELECT conv_id, turn, p, [p, turn] AS path FROM link
                                UNION ALL SELECT up.conv_id, up.turn, link.p, list_prepend(link.p, path) FROM up JOIN link ON up.conv_id = link.conv_id AND up.p = link.turn)
          SELECT conv_id, turn, min(p) AS root, arg_max(path, len(path)) AS path FROM up GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, link.p AS reply_to, CAST(quote_levels AS INT) AS quote_levels, coalesce(root, m.turn) AS root_turn, coalesce(path, [m.turn]) AS reply_path,
       CASE WHEN m.text IS NOT NULL THEN body END AS body, CASE WHEN m.text IS NOT NULL THEN concat_ws(': ', m.role, body) END AS chat
FROM m JOIN own_text USING (rowid_)
LEFT JOIN link ON link.conv_id = m.conv_id AND link.turn = m.turn LEFT JOIN chain ON chain.conv_id = m.conv_id AND chain.turn = m.turn
"""
