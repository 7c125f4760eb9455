"""A training corpus from ``documents``, in five stages, each a Spark job over all rows that the one before has kept.

Every stage but the last returns the columns of ``documents``; the last returns the token ids. Between stages the rows
are written as Parquet and read again, so a lost executor costs tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quizloom.llm import bpe, lang_id, minhash, mixing, substring_dedup
from quizloom.llm.common import Scratch
from quizloom.llm.queries import vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Tasks that the rows of one group of near-duplicates are dealt to.
SALTS = 64


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter (null texts too) and those whose likeliest language is hardly likelier than chance.

    The model learns from the rows that name a language; those without get the predicted one. Without any such row nothing but und can be said: then
    only documents without a letter go.
    """
    model = lang_id.train(docs.select("doc_id", "text", "lang"))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = lang_id.predict(docs, model).where((F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= min(1.0, 1.2 / len(model.langs))))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group (five-word shingles, similarity 0.8 or more) one row: that with the smallest id, where there is one; of equal ids any.

    Rows are told apart by a number of their own, so rows without id and rows that share one are judged each by their text. Rows without words are in no group.
    """
    numbered = Scratch(spark, "near").save(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = minhash.near_duplicates(numbered, size=5, percent=80, key="__row").select("__row", F.col("component_id").alias("__group"))
    ranked = found.join(numbered.select("__row", "doc_id"), "__row").select("__group", F.struct(F.col("doc_id").isNull(), "doc_id", "__row").alias("__rank"))
    first = ranked.groupBy("__group").agg(F.min("__rank").alias("__first"), F.count("*").alias("n")).where("n > 1").select("__group", F.col("__first.__row").alias("__kept"))
    # a group may hold a third of all rows: its rows are dealt to SALTS tasks
    salted = first.withColumn("__salt", F.explode(F.lit(list(range(SALTS))).cast("array<long>")))
    gone = found.withColumn("__salt", F.pmod(F.xxhash64("__row"), F.lit(SALTS))).join(salted, ["__group", "__salt"]).where("__row <> __kept").select("__row")
    return numbered.join(gone, "__row", "left_anti").select(docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 25 words or more that a document with a smaller id has too. Every document stays, if with less text; n_chars follows the text."""
    found = substring_dedup.drop_repeats(docs, window=25)
    return found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that in the mean a source weighs the square root of its characters, in a global random order."""
    return mixing.mix(docs).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256, ids of each row, and part and place: in their order the rows stand as in the files that ``docs`` is read from,
    which is the random order of mixing. Both are null where ``docs`` is not read from files."""
    placed = [F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("place")]
    columns = ["doc_id", "lang", "source", "text"]
    try:
        rows = docs.select(*columns, *placed)
    except AnalysisException:  # no files
        rows = docs.select(*columns, F.lit(None).cast("string").alias("part"), F.lit(None).cast("long").alias("place"))
    out = bpe.encode(rows, vocabulary_path(), ids=True)
    return out.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "part", "place")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("bpe", encode),
]
#: Language identification has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
