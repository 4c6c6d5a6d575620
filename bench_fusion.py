"""Compare fused rules with one pass per rule, as the number of rules grows.

Prints one JSON line per number of rules. ``one_by_one`` applies each rule as a
plan of its own on top of the one before, the way a script of deletes would.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from tablewinnow.fixtures import Views
from tablewinnow.plans.prune_plan import PrunePlan
from tablewinnow.plans.rules import DATASETS, Removal


def removals(count: int) -> list[Removal]:
    """Rules over one data set each, every other one narrowed to a subtree."""
    return [
        Removal(
            rule=i,
            family=DATASETS,
            scope=(f"Brand#{i % 25 + 1}",),
            units_below=(f"N{i % 25}",) if i % 2 else (f"R{i % 5}", f"N{i % 7}"),
        )
        for i in range(count)
    ]


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def fused(spark: SparkSession, folder: str, rules: list[Removal]) -> None:
    compute(PrunePlan(Views(spark, folder), rules).table("datavalue"))


def one_by_one(spark: SparkSession, folder: str, rules: list[Removal]) -> None:
    tables = dict(Views(spark, folder))
    for rule in rules:
        tables["datavalue"] = PrunePlan(tables, [rule]).table("datavalue")
    compute(tables["datavalue"])


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for way in (fused, one_by_one):
        way(spark, folder, removals(2))
    for count in (1, 4, 16, 64):
        seconds = {}
        for way in (fused, one_by_one) if count <= 16 else (fused,):
            start = time.perf_counter()
            way(spark, folder, removals(count))
            seconds[way.__name__] = round(time.perf_counter() - start, 2)
        print(json.dumps({"rules": count, **seconds}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
