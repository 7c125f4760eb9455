"""Maintenance jobs: ``python -m quizloom sync | shuffle | dedup ...`` on Parquet banks."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quizloom.functions import text
from quizloom.operators import dedup
from quizloom.plans import workflows
from quizloom.sources.bank import counted
from quizloom.sources.seen import SeenState


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quizloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    sync = jobs.add_parser("sync", help="append the source's new rows to the target")
    sync.add_argument("--source", required=True)
    sync.add_argument("--target", required=True)
    sync.add_argument("--id-field", default="question_id")
    sync.add_argument("--dry-run", action="store_true")
    shuffle = jobs.add_parser("shuffle", help="shuffle the options of a bank into a new table")
    shuffle.add_argument("--bank", required=True)
    shuffle.add_argument("--out", required=True)
    shuffle.add_argument("--id-field", default="_id")
    shuffle.add_argument("--seed", required=True)
    unique = jobs.add_parser("dedup", help="questions that no earlier run has, and the new state of seen hashes")
    unique.add_argument("--bank", required=True)
    unique.add_argument("--out", required=True)
    unique.add_argument("--seen", required=True)
    unique.add_argument("--version", type=int, help="for calls of old; the newest version of the state is found without it")
    unique.add_argument("--text-field", default="question")
    unique.add_argument("--id-field", default="_id")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    if args.job == "sync":
        source, target = spark.read.parquet(args.source), spark.read.parquet(args.target)
        counts = workflows.sync(source, target, args.id_field)[1].first().asDict()
        if args.dry_run:
            return counts | {"synced_count": 0}
        # every source row of an added id, repeats too
        added = source.where(F.col(args.id_field).isNotNull()).join(target.select(args.id_field), args.id_field, "left_anti")
        return counts | {"synced_count": counted(added.select(target.columns), lambda out: out.write.mode("append").parquet(args.target))["n"]}
    if args.job == "shuffle":
        return {"rows": counted(workflows.shuffle_bank(spark.read.parquet(args.bank), args.id_field, args.seed), lambda out: out.write.parquet(args.out))["n"]}
    rows = spark.read.parquet(args.bank).withColumn("hash", text.dedup_hash(text.canonical_text(F.col(args.text_field))))
    state = SeenState(spark, args.seen)
    n = counted(state.unseen(dedup.first_seen(rows, "hash", args.id_field)), lambda out: out.write.parquet(args.out))["n"]
    state.add(spark.read.schema(rows.schema).parquet(args.out))  # nothing new leaves the state as it is
    return {"rows": n}


if __name__ == "__main__":
    print(json.dumps(run(SparkSession.builder.appName("quizloom").getOrCreate(), arguments())))
