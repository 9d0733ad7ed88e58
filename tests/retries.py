"""Run by test_retries.py in a process of its own: every other task fails at its first attempt."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark import TaskContext
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from assay.operators import latest_per_key, left_lookup, with_surrogate_key, with_validity_end
from assay.session import tune

ALL_HOT = {"rows_per_task": 0, "sample": 1.0}


def fail_once(batches):
    task = TaskContext.get()
    for batch in batches:
        yield batch
    if task.attemptNumber() == 0 and task.partitionId() % 2:
        raise OSError("lost")


def flaky(df):
    return df.mapInArrow(fail_once, df.schema)


def differences(found, expected):
    return found.exceptAll(expected).count() + expected.exceptAll(found).count()


def main(folder: str) -> None:
    spark = tune(
        SparkSession.builder.master("local[4,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", folder)
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    number = F.col("id")
    rows = spark.range(0, 3000, 1, 8).select(
        F.when(number % 3 == 0, 0).otherwise(number % 50).cast("int").alias("key"),
        F.date_add(F.lit("2020-01-01").cast("date"), (number % 17).cast("int")).alias("start"),
        (number % 400).alias("tie"),
    )
    shuffled = flaky(rows.repartition(6, "tie"))

    numbered = F.row_number().over(Window.orderBy("key", "start", "tie")).cast("bigint")
    keyed = with_surrogate_key(shuffled, "n", ["key", "start"], ["tie"])
    print("surrogate", differences(flaky(keyed), rows.select(numbered.alias("n"), "*")))

    in_order = Window.partitionBy("key").orderBy("start", "tie")
    ended = rows.withColumn("end", F.date_sub(F.lead("start").over(in_order), 1))
    for name, limits in (("window", {}), ("calendar", ALL_HOT)):
        found = with_validity_end(shuffled, ["key"], "start", "end", ["tie"], **limits)
        print(name, differences(flaky(found), ended))

    newest = rows.withColumn(
        "r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("start"), F.desc("tie")))
    )
    newest = newest.where("r = 1").drop("r")
    print("latest", differences(flaky(latest_per_key(shuffled, ["key"], ["start"])), newest))

    keys = spark.range(0, 80, 1, 4).select(number.cast("int").alias("fk"))
    joined = keys.join(rows, F.col("fk") == F.col("key"), "left").drop("key")
    for name, limits in (("plain", {}), ("salted", ALL_HOT)):
        found = left_lookup(flaky(keys), shuffled, "fk", "key", **limits)
        print(name, differences(flaky(found), joined))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
