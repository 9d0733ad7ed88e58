"""Skewed, enlarged data: each operator against its plain form, by time and by result.

``scale_trial.py [copies] [folder]`` reads lineitem ``copies`` times over (default 40); two of seven
lines share one key. Prints one line per operator. The plain form is what one writes without thinking
of skew: a window without partitions, one scan per check, a join as it comes.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from assay.operators import (  # noqa: E402
    latest_per_key,
    left_lookup,
    with_surrogate_key,
    with_validity_end,
)
from assay.quality import QualityRunner  # noqa: E402
from assay.session import local_session, stage  # noqa: E402


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 40
    folder = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = local_session(
        "trial", 8, **{"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": "64"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").repartition(32)
    rows = stage(
        lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select(
            F.when(F.col("l_linenumber") <= 2, -1)
            .otherwise(F.col("l_partkey") * copies + F.col("copy"))
            .alias("key"),
            F.date_add(F.col("l_shipdate").cast("date"), F.col("copy")).alias("start"),
            (F.col("l_orderkey") * copies + F.col("copy")).alias("number"),
            "l_linenumber",
            "l_suppkey",
            "l_extendedprice",
        ),
        "trial",
    )
    total = rows.count()
    hot = rows.where("key = -1").count()
    print(f"{total:,} rows, {hot / total:.0%} of them with one key", flush=True)

    ties = ["number", "l_linenumber", "l_suppkey", "l_extendedprice"]
    order = ["key", "start", *ties]

    def window_end():
        in_order = Window.partitionBy("key").orderBy("start", *ties)
        return rows.withColumn("end", F.date_sub(F.lead("start").over(in_order), 1))

    times = rows.withColumn(
        "start", F.timestamp_seconds(F.unix_date("start") * 86_400 + F.col("number") % 86_400)
    )

    def window_end_of_times():
        in_order = Window.partitionBy("key").orderBy("start", *ties)
        return times.withColumn("end", F.date_sub(F.lead("start").over(in_order), 1))

    def latest_by_max():
        newest = F.max(F.struct("start", *ties)).alias("newest")
        return rows.groupBy("key").agg(newest).select("key", "newest.*")

    def numbered_by_window():
        numbered = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        return rows.select(numbered.alias("n"), *rows.columns)

    values = rows.select(
        F.col("key").alias("pk"), F.concat_ws("-", "number", "l_linenumber").alias("value")
    )
    few = rows.groupBy("key").agg(F.max("l_suppkey").alias("supplier"))

    compare("validity end", lambda: with_validity_end(rows, ["key"], "start", "end", ties), window_end)
    compare(
        "validity end of times",
        lambda: with_validity_end(times, ["key"], "start", "end", ties),
        window_end_of_times,
    )
    compare("latest per key", lambda: latest_per_key(rows, ["key"], ["start"]), latest_by_max)
    compare(
        "surrogate key",
        lambda: with_surrogate_key(rows, "n", ["key", "start"], ties),
        numbered_by_window,
    )
    compare(
        "lookup, right side skewed",
        lambda: left_lookup(few, values, "key", "pk"),
        lambda: few.join(values, F.col("key") == F.col("pk"), "left").drop("pk"),
    )
    compare(
        "lookup, left side skewed",
        lambda: left_lookup(rows, few.withColumnRenamed("key", "pk"), "key", "pk"),
        lambda: rows.join(few.withColumnRenamed("key", "pk"), F.col("key") == F.col("pk"), "left")
        .drop("pk"),
    )

    columns = ["number", "start", "l_suppkey", "l_extendedprice"]

    def checks():
        runner = QualityRunner(spark, "silver").check_nulls(rows, "rows", columns)
        runner.check_duplicates(rows, "rows", ["key"]).check_row_count(rows, "rows", 1)
        return [(r["records_total"], r["records_failed"]) for r in runner.results]

    def counts_one_by_one():
        nulls = [(rows.count(), rows.where(F.col(c).isNull()).count()) for c in columns]
        keys = rows.dropDuplicates(["key"]).count()
        return [*nulls, (rows.count(), rows.count() - keys), (rows.count(), 0)]

    began = time.perf_counter()
    ours = checks()
    middle = time.perf_counter()
    plain = counts_one_by_one()
    report("six checks", middle - began, time.perf_counter() - middle, ours == plain)


def compare(name, ours, plain) -> None:
    seconds, results = [], []
    for build in (ours, plain):
        began = time.perf_counter()
        df = build()
        columns = sorted(df.columns)
        total = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
        results.append((columns, df.agg(F.count(F.lit(1)), total).first()))
        seconds.append(time.perf_counter() - began)
    report(name, *seconds, results[0] == results[1])


def report(name, ours, plain, equal) -> None:
    verdict = "equal" if equal else "DIFFERENT"
    print(f"{name:28} {ours:7.1f} s   plain {plain:7.1f} s   {verdict}", flush=True)


if __name__ == "__main__":
    main()
