"""Tables with a key and versions: rows in buckets by their key, and a manifest for each version that names the files of each bucket.

A change reads and writes the buckets of its keys only; files are never altered. It takes effect when its manifest appears under the next number, by one rename that
fails if another writer was first: then the change is made again over that writer's version, or, if the other one left its buckets alone, published as it is. Readers
and writers find the newest version by themselves; a change without rows makes none, and an older version stays readable until ``vacuum`` takes it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quizloom.tables import Tables

BUCKET, COMMIT = "store_bucket", "store_commit"
#: Writers that a change gives way to before it fails.
ATTEMPTS = 20


@dataclass(frozen=True)
class Manifest:
    """One version: of each bucket the commits that hold its rows, and how many they are."""

    version: int
    key: str
    schema: str
    buckets: int
    files: dict[str, list[str]] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    properties: dict[str, int] = field(default_factory=dict)
    #: The last change of each stream of changes, so that one that is repeated after a failure counts once.
    done: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(self.counts.values())


@dataclass(frozen=True)
class Change:
    """What a change writes: the buckets it read, the rows of buckets in a new commit, and which buckets it replaces."""

    read: frozenset[int]
    commit: str
    counts: dict[str, int]
    replaces: frozenset[int] = frozenset()
    properties: dict[str, int] = field(default_factory=dict)


class Conflict(RuntimeError):
    """Other writers were first every time."""


class Files:
    """A folder of the session's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.conf = spark._jsc.hadoopConfiguration()
        self.system = self.at("").getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.system.listStatus(self.at(folder))] if self.system.exists(self.at(folder)) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, body: str) -> bool:
        """Write a file whole; false if there is one of the name."""
        part = f"{name}.{uuid.uuid4().hex}.part"
        stream = self.system.create(self.at(part), False)
        stream.write(bytearray(body.encode()))
        stream.close()
        if self.move(part, name):
            return True
        self.delete(part)
        return False

    def move(self, name: str, to: str) -> bool:
        """Rename a file or folder; false if there is one of the new name."""
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        none = self.jvm.java.lang.reflect.Array.newInstance(options.NONE.getClass(), 1)
        none[0] = options.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), self.conf)
        try:
            context.rename(self.at(name), self.at(to), none)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception.toString()):
                raise
            return False
        return True

    def delete(self, name: str) -> None:
        self.system.delete(self.at(name), True)


class Store:
    """A table at ``path``. ``buckets`` is set once: as many as the table has parts that a task can rewrite, when it is full.

    Rows are taken in the table's types; columns that it has not are left out. The column that orders repeated keys is one of the table's.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path.rstrip("/"))

    @classmethod
    def open(cls, spark: SparkSession, path: str, schema: str | StructType, key: str, buckets: int = 64, properties: dict[str, int] | None = None) -> Store:
        """The table at the path, made without rows and with these properties if there is none; another key than the table's is an error."""
        store = cls(spark, path)
        ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        if not store.versions():
            store._publish(Manifest(0, key, ddl, buckets, properties=properties or {}))
        if store.manifest().key != key:
            raise ValueError(f"the table at {path} has the key {store.manifest().key!r}, not {key!r}")
        return store

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names("manifests") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """Of the newest version, or of the one asked for; one that is not there is an error."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise ValueError(f"no version {version if known else ''} of the table at {self.path}: {known[:1]} to {known[-1:]} are there")
        return Manifest(**json.loads(self.files.read(f"manifests/{known[-1] if version is None else version:012d}.json")))

    def read(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        return self._rows(m).select(self._names(m))

    def upsert(self, rows: DataFrame, order: str | None = None, batch: tuple[str, int] | None = None) -> Manifest:
        """Rows take the place of those with their keys. Of repeated keys the last by ``order`` counts (among equals, and without an order, the greatest row); rows without key are left out.

        ``batch`` (a stream of changes, its number) makes a repeated change count once.
        """

        def change(m: Manifest, new: DataFrame) -> Change | None:
            read = self._buckets_of(new)
            merged = self.rows_in(read, m).join(new.select(m.key), m.key, "left_anti").unionByName(new.select(self._names(m)))
            return Change(read, *self._write(merged, m), read) if read else None

        return self._commit(self._single(rows, order), change, batch)

    def combine(self, rows: DataFrame, how: dict[str, Callable[[str], Column]], batch: tuple[str, int] | None = None) -> Manifest:
        """Values of rows with equal keys, those of the table too, are combined by an aggregation of each column."""

        def combined(r: DataFrame, key: str) -> DataFrame:
            return r.groupBy(key).agg(*[f(c).alias(c) for c, f in how.items()])

        def change(m: Manifest, new: DataFrame) -> Change | None:
            read = self._buckets_of(new)
            return Change(read, *self._write(combined(self.rows_in(read, m).unionByName(new.select(self._names(m))), m.key), m), read) if read else None

        key = self.manifest().key
        return self._commit(self._dealt(combined(self._typed(rows).where(F.col(key).isNotNull()), key)), change, batch)

    def insert(self, rows: DataFrame, order: str | None = None, batch: tuple[str, int] | None = None, single: bool = False) -> Manifest:
        """Rows whose key the table lacks are added, in files beside those of their buckets. Of repeated keys the first by ``order`` counts (among equals, and without an order, the smallest row).

        ``single`` tells that the rows are a written table with one row a key.
        """

        def change(m: Manifest, new: DataFrame) -> Change | None:
            read = self._buckets_of(new)
            commit, counts = self._write(new.select(self._names(m)).join(self._rows(m, read).select(m.key), m.key, "left_anti"), m) if read else ("", {})
            return Change(read, commit, counts) if counts else None

        return self._commit(self._typed(rows).withColumn(BUCKET, self.bucket(self.manifest())) if single else self._single(rows, order, first=True), change, batch)

    def update(self, changes: DataFrame, fields: Sequence[str], batch: tuple[str, int] | None = None) -> Manifest:
        """Sets the fields of rows that the table has; changes of other keys are left out."""
        from quizloom.operators.delta import merge_changes

        def change(m: Manifest, new: DataFrame) -> Change | None:
            read = self._buckets_of(new)
            had = self._rows(m, read).join(new.select(m.key), m.key, "left_semi").select(BUCKET).distinct()
            touched = frozenset(r[0] for r in had.collect())
            return Change(read, *self._write(merge_changes(self.rows_in(touched, m), new, m.key, list(fields)), m), touched) if touched else None

        return self._commit(self._single(changes.select(self.manifest().key, *fields), None), change, batch)

    def delete(self, keys: DataFrame, batch: tuple[str, int] | None = None) -> Manifest:
        def change(m: Manifest, gone: DataFrame) -> Change | None:
            read = self._buckets_of(gone)
            had = self._rows(m, read).join(gone.select(m.key), m.key, "left_semi").select(BUCKET).distinct()
            touched = frozenset(r[0] for r in had.collect())
            return Change(read, *self._write(self.rows_in(touched, m).join(gone.select(m.key), m.key, "left_anti"), m), touched) if touched else None

        return self._commit(self._single(keys.select(self.manifest().key), None), change, batch)

    def replace(self, rows: DataFrame, properties: dict[str, int] | None = None) -> Manifest:
        """All rows anew, with properties of the version."""

        def change(m: Manifest, new: DataFrame) -> Change:
            every = frozenset(range(m.buckets))
            return Change(every, *self._write(new.select(self._names(m)), m), every, properties or {})

        return self._commit(self._single(rows, None), change, None)

    def vacuum(self, keep: int = 2) -> int:
        """Deletes all but the newest versions and the commits that only older ones name; how many commits went."""
        known = self.versions()
        used = {c for v in known[-keep:] for cs in self.manifest(v).files.values() for c in cs}
        oldest = {c for v in known[:-keep] for cs in self.manifest(v).files.values() for c in cs} - used
        for v in known[:-keep]:
            self.files.delete(f"manifests/{v:012d}.json")
        for c in oldest:
            self.files.delete(f"data/{COMMIT}={c}")
        return len(oldest)

    @staticmethod
    def _names(m: Manifest) -> list[str]:
        return StructType.fromDDL(m.schema).names

    def _typed(self, rows: DataFrame) -> DataFrame:
        """The table's columns that the rows have, in its types: a key of another type would have another bucket."""
        kinds = {f.name: f.dataType for f in StructType.fromDDL(self.manifest().schema).fields}
        return rows.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in rows.columns if c in kinds])

    def bucket(self, m: Manifest):
        return F.pmod(F.xxhash64(m.key), F.lit(m.buckets)).cast("int")

    def _rows(self, m: Manifest, buckets: frozenset[int] | None = None) -> DataFrame:
        """The rows of some buckets, with the bucket beside."""
        schema = f"{m.schema}, {BUCKET} int"
        paths = [f"{self.path}/data/{COMMIT}={c}/{BUCKET}={b}" for b, commits in m.files.items() if buckets is None or int(b) in buckets for c in commits]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths).select(*self._names(m), BUCKET)

    def rows_in(self, buckets: frozenset[int], m: Manifest) -> DataFrame:
        return self._rows(m, buckets).select(self._names(m))

    def _buckets_of(self, new: DataFrame) -> frozenset[int]:
        """At most as many numbers as there are buckets."""
        return frozenset(r[0] for r in new.select(BUCKET).distinct().collect())

    def _single(self, rows: DataFrame, order: str | None, first: bool = False) -> DataFrame:
        """A row for each key, with its bucket."""
        m = self.manifest()
        have = self._typed(rows).where(F.col(m.key).isNotNull())
        rest = [c for c in have.columns if c != m.key]
        if rest:
            whole = F.struct(*([F.col(order).alias("__order")] if order else []), *rest)
            one = F.min(whole) if first else F.max(whole)
            have = have.groupBy(m.key).agg(one.alias("__one")).select(m.key, *[F.col("__one").getField(c).alias(c) for c in rest])
        else:
            have = have.distinct()
        return self._dealt(have)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """The rows with their bucket, written, so that a change made again sees the same ones."""
        return Tables(self.spark, "store").save(rows.withColumn(BUCKET, self.bucket(self.manifest())), "rows")

    def _write(self, rows: DataFrame, m: Manifest) -> tuple[str, dict[str, int]]:
        """A new commit, and how many rows of each bucket it has, by the files that tasks have committed."""
        commit = uuid.uuid4().hex
        path = f"{self.path}/data/{COMMIT}={commit}"
        rows.withColumn(BUCKET, self.bucket(m)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)
        counts = self.spark.read.schema(f"{m.schema}, {BUCKET} int").parquet(path).groupBy(BUCKET).count().collect()  # no column is read
        return commit, {str(r[BUCKET]): r["count"] for r in counts}

    def _publish(self, m: Manifest) -> bool:
        return self.files.publish(f"manifests/{m.version:012d}.json", json.dumps(asdict(m)))

    def _commit(self, rows: DataFrame, change: Callable[[Manifest, DataFrame], Change | None], batch: tuple[str, int] | None) -> Manifest:
        base, made, fresh = self.manifest(), None, True
        for _ in range(ATTEMPTS):
            if batch and base.done.get(batch[0], -1) >= batch[1]:
                return base
            if fresh:
                made = change(base, rows)
            if made is None:
                return base
            kept = {b for b in base.files if int(b) not in made.replaces}
            files = {b: (base.files[b] if b in kept else []) + [made.commit] * (b in made.counts) for b in {*kept, *made.counts}}
            counts = {b: (base.counts[b] if b in kept else 0) + made.counts.get(b, 0) for b in files}
            done = base.done | ({batch[0]: batch[1]} if batch else {})
            new = replace(base, version=base.version + 1, files=files, counts=counts, properties=base.properties | made.properties, done=done)
            if self._publish(new):
                return new
            before, base = base, self.manifest()
            fresh = any(before.files.get(str(b)) != base.files.get(str(b)) for b in made.read)  # else what was written holds beside the other change
        raise Conflict(f"{ATTEMPTS} other changes to {self.path} came first")
