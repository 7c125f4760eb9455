"""Tables of a bank: reading state that may not exist yet, and the sinks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from quizloom.operators.lookup import first_by
from quizloom.sources.store import Store


def table_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A Parquet table, or no rows if there is none at the path."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


#: Ids that one request to a database asks for.
IDS_A_REQUEST = 1000


def jdbc(spark: SparkSession, url: str, table: str, user_variable: str | None = None, password_variable: str | None = None, column: str | None = None, parts: int = 8, ids: Iterable[int | str] | None = None, **options: str) -> DataFrame:
    """A relational table; credentials come from the driver's environment.

    With an integer ``column`` it is read in ``parts`` ranges between the column's least and greatest value. With ``ids``, an argument list, only rows with these values of
    the column are asked for, IDS_A_REQUEST in a request; no ids, no rows. Filters and columns go to the database as with any such table.
    """
    login = {k: os.environ[v] for k, v in (("user", user_variable), ("password", password_variable)) if v}
    options = {k: str(v) for k, v in (login | options).items()}
    if ids is not None:
        wanted = sorted(set(ids), key=str)
        texts = [str(int(i)) if isinstance(i, int) else "'" + i.replace("'", "''") + "'" for i in wanted]
        asked = [f"{column} IN ({', '.join(texts[k : k + IDS_A_REQUEST])})" for k in range(0, len(texts), IDS_A_REQUEST)]
        return spark.read.jdbc(url, table, predicates=asked or ["1 = 0"], properties=options)
    reader = spark.read.format("jdbc").options(**options).option("url", url)
    if column:
        low, high = reader.option("dbtable", f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) bounds").load().first()
        if low is not None and low < high:
            reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(min(parts, high - low + 1)))
    return reader.option("dbtable", table).load()


def append_new(rows: DataFrame, path: str, key: str, *order: str) -> int:
    """Append the rows whose key the table lacks; how many. A rerun writes nothing twice.

    Of repeated keys the first row by ``order`` stays (among equals, and without an order, the smallest); rows without key are left out.
    """
    known = table_or_empty(rows.sparkSession, path, rows.schema).select(key)
    first = first_by(rows.where(F.col(key).isNotNull()), [key], *order)
    return counted(first.join(known, key, "left_anti").select(rows.columns), lambda out: out.write.mode("append").parquet(path))["n"]


def counted(rows: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict[str, int]:
    """Write the rows; ``n``, and sums of conditions, as the tasks that write have counted them. The rows are computed once."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in metrics.items()]]
    write(rows.observe(seen, *counts))
    try:
        return {k: v or 0 for k, v in seen.get.items()}
    except Py4JJavaError:  # a plan found empty while it runs has nothing to observe
        return dict.fromkeys(("n", *metrics), 0)


def upsert(rows: DataFrame, path: str, key: str, order: str | None = None) -> Store:
    """The keyed table at the path, made if it is not there, in which ``rows`` take the place of those with their keys (see ``Store.upsert``)."""
    store = Store.open(rows.sparkSession, path, rows.schema, key)
    store.upsert(rows, order)
    return store


def write_output(rows: DataFrame, mode: str, path: str) -> None:
    """``file``: JSON lines; ``table``: Parquet. Anything else is an error."""
    if mode == "file":
        rows.write.mode("append").json(path)
    elif mode == "table":
        rows.write.mode("append").parquet(path)
    else:
        raise ValueError(f"no such output mode: {mode!r}")


def write_texts(rows: DataFrame, name: Column, text: Column, path: str) -> None:
    """Raw texts in a folder for each file-safe name."""
    rows.select(F.translate(name, " /", "__").alias("name"), text.alias("value")).write.mode("append").partitionBy("name").text(path)


def image_rows(rows: DataFrame, key: str, payload: Column) -> DataFrame:
    """id, file name ending in .png, bytes from base64; null payloads go."""
    named = F.concat(F.lit("diagram_"), F.regexp_replace(F.col(key).cast("string"), r"\.png$", ""), F.lit(".png"))
    return rows.where(payload.isNotNull()).select(key, named.alias("file"), F.unbase64(payload).alias("content"))


def write_images(images: DataFrame, folder: str) -> None:
    """One file for each row, written by the tasks to a mounted folder that all executors share."""

    def run(part):
        os.makedirs(folder, exist_ok=True)
        for row in part:
            path = os.path.join(folder, row.file)
            with open(f"{path}.part", "wb") as f:
                f.write(row.content)
            os.replace(f"{path}.part", path)

    images.select("file", "content").foreachPartition(run)
