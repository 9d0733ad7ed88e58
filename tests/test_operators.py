import random
import re
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from assay import session
from assay.operators import (
    duplicate_counts,
    find_hot_keys,
    latest_per_key,
    left_lookup,
    orphan_counts,
    orphan_rows,
    surrogate,
    with_surrogate_key,
    with_validity_end,
)

ALL_HOT = {"rows_per_task": 0, "sample": 1.0}


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def some_versions(seed, n=400):
    """Keys of all sizes: one with a third of the rows, a NULL one, and many exact copies."""
    pick = random.Random(seed)
    rows = []
    for number in range(n):
        key = pick.choice(["hot", "hot", "hot", None, *"abcdefg"])
        day = None if pick.random() < 0.05 else date(2020, 1, 1) + timedelta(pick.randrange(12))
        rows.append((key, day, pick.choice([None, 1, 2, number]), pick.choice("xy")))
    return rows + rows[: n // 3]


def nulls_first(value):
    return (value is not None, value)


def ends_by_hand(rows):
    """Validity ends for rows (key, start, tie-breaker, payload)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    out = Counter()
    for group in groups.values():
        group.sort(key=lambda r: tuple(nulls_first(v) for v in r[1:]))
        for row, following in zip(group, [*group[1:], None], strict=True):
            start = following[1] if following else None
            out[(*row, start - timedelta(1) if start else None)] += 1
    return out


VERSIONS = "key string, start date, tie int, payload string"


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(
    "limits",
    [{}, ALL_HOT, {"rows_per_task": 100, "sample": 1.0}],
    ids=["window", "calendar", "both"],
)
def test_validity_ends(spark, many_partitions, seed, limits):
    rows = some_versions(seed)
    df = spark.createDataFrame(rows, VERSIONS).repartition(5)
    found = with_validity_end(df, ["key"], "start", "end", ["tie", "payload"], **limits)
    assert found.columns == ["key", "start", "tie", "payload", "end"]
    assert rows_of(found) == ends_by_hand(rows)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(
    "limits",
    [{}, ALL_HOT, {"rows_per_task": 7, "sample": 1.0}, {"rows_per_task": 100, "sample": 1.0}],
    ids=["window", "position", "blocks", "both"],
)
def test_validity_ends_of_times(spark, many_partitions, kind, limits):
    pick = random.Random(len(limits))
    rows = []
    for number in range(500):
        key = pick.choice(["hot", "hot", "hot", None, *"abcdefg"])
        moment = datetime(2020, 1, 1) + timedelta(seconds=pick.randrange(400_000))
        rows.append((key, None if pick.random() < 0.05 else moment, pick.choice([None, 1, number]), "x"))
    rows += rows[:150]
    df = spark.createDataFrame(rows, VERSIONS.replace("date", kind)).repartition(5)
    found = with_validity_end(df, ["key"], "start", "end", ["tie", "payload"], **limits)
    want = Counter()
    for row, count in ends_by_hand(rows).items():
        want[(*row[:-1], row[-1] and row[-1].date())] += count
    assert rows_of(found) == want


def test_a_hot_key_of_times_is_dealt_evenly(spark, many_partitions):
    """Blocks of positions, not keys, go to the tasks."""
    moments = spark.range(0, 20_000, 1, 4).select(
        F.lit("hot").alias("key"),
        (F.lit(datetime(2020, 1, 1)) + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("start"),
        "id",
    )
    found = with_validity_end(moments, ["key"], "start", "end", ["id"], rows_per_task=500, sample=1.0)
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 20_000
    assert len(sizes) == 4 and max(r["count"] for r in sizes) <= 3 * 20_000 / 4
    assert found.where("end IS NULL").count() == 1


@pytest.mark.parametrize("limits", [{}, ALL_HOT])
def test_validity_of_single_and_no_rows(spark, limits):
    one = spark.createDataFrame([("a", date(2020, 1, 1), 1, "x")], VERSIONS)
    found = with_validity_end(one, ["key"], "start", "end", ["tie"], **limits).collect()
    assert [r.end for r in found] == [None]
    none = with_validity_end(one.where("false"), ["key"], "start", "end", ["tie"], **limits)
    assert none.count() == 0


def test_level_rows_are_ordered_alike_in_every_run(spark, many_partitions):
    """Rows that no given column tells apart, read in different orders, by both ways."""
    day = date(2020, 1, 1)
    rows = [("a", day, 1, text) for text in ("p", "q", None, "r")] + [("a", day, None, "p")]
    results = []
    for shift, limits in ((0, {}), (2, {}), (3, ALL_HOT), (1, ALL_HOT)):
        df = spark.createDataFrame(rows[shift:] + rows[:shift], VERSIONS).repartition(3)
        results.append(rows_of(with_validity_end(df, ["key"], "start", "end", [], **limits)))
        keyed = with_surrogate_key(df, "number", ["key"])
        results.append(rows_of(keyed))
    assert results[0] == results[2] == results[4] == results[6]
    assert results[1] == results[3] == results[5] == results[7]


def test_validity_needs_dates(spark):
    df = spark.createDataFrame([("a", 1)], "key string, start int")
    with pytest.raises(TypeError):
        with_validity_end(df, ["key"], "start", "end", ["start"])


def test_hot_keys_are_the_large_ones(spark):
    df = spark.createDataFrame([("a",)] * 50 + [(None,)] * 40 + [("b",)] * 5, "key string")
    found = find_hot_keys(df, ["key"], rows_per_task=20, sample=1.0)
    assert {r.key for r in found.collect()} == {"a", None}
    assert find_hot_keys(df, ["key"], rows_per_task=60, sample=1.0) is None
    assert find_hot_keys(df, ["key"]) is None


def test_latest_row_per_key(spark, many_partitions):
    day = date(2020, 1, 1)
    rows = [
        (1, day, "old"), (1, day + timedelta(1), "new"), (1, None, "undated"),
        (2, day, "tie a"), (2, day, "tie b"),
        (None, day, "n1"), (None, day + timedelta(3), "n2"),
        (3, None, "only"),
    ]
    schema = "id int, created date, name string"
    expected = Counter([
        (1, day + timedelta(1), "new"), (2, day, "tie b"), (None, day + timedelta(3), "n2"),
        (3, None, "only"),
    ])
    for shift in range(3):
        df = spark.createDataFrame(rows[shift:] + rows[:shift], schema).repartition(3)
        assert rows_of(latest_per_key(df, ["id"], ["created"])) == expected


def test_latest_row_is_limited_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    latest_per_key(df, ["k"], ["id"]).explain()
    plan = capsys.readouterr().out
    final, partial = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert final < plan.index("Exchange") < partial


@pytest.mark.parametrize("seed", range(3))
def test_surrogate_keys_equal_one_global_window(spark, many_partitions, seed):
    rows = some_versions(seed)
    df = spark.createDataFrame(rows, VERSIONS).repartition(7)
    keyed = with_surrogate_key(df, "number", ["key", "start"], ["tie", "payload"])
    assert keyed.columns == ["number", "key", "start", "tie", "payload"]
    assert dict(keyed.dtypes)["number"] == "bigint"
    ordered = sorted(rows, key=lambda r: tuple(nulls_first(v) for v in r))
    assert rows_of(keyed) == Counter((n, *row) for n, row in enumerate(ordered, 1))


def test_surrogate_keys_stay_the_same_on_each_read(spark, many_partitions):
    df = spark.range(1000).select(F.hash("id").alias("h"), (F.col("id") % 7).alias("k"))
    keyed = with_surrogate_key(df.repartition(5), "number", ["k"], ["h"])
    assert rows_of(keyed) == rows_of(keyed)
    assert keyed.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first() == (
        1, 1000, 1000,
    )


def test_equal_rows_are_sorted_by_several_tasks(spark, many_partitions, monkeypatch):
    """Copies that fill the whole table must not all meet in one sorted partition."""
    staged = []

    def stage(df, label):
        staged.append(session.stage(df, label))
        return staged[-1]

    monkeypatch.setattr(surrogate, "stage", stage)
    df = spark.range(0, 40_000, 1, 16).select(F.lit("same").alias("key"))
    keyed = with_surrogate_key(df, "number", ["key"])
    assert keyed.agg(F.max("number"), F.count_distinct("number")).first() == (40_000, 40_000)
    assert staged[0].groupBy("_part").count().count() == 4


def test_surrogate_keys_of_no_rows(spark):
    df = spark.createDataFrame([], "key string")
    assert with_surrogate_key(df, "number", ["key"]).count() == 0


def joined_by_hand(left, right):
    matches = defaultdict(list)
    for key, value in right:
        if key is not None:
            matches[key].append(value)
    return Counter(
        (key, number, value) for key, number in left for value in matches.get(key) or [None]
    )


@pytest.mark.parametrize(
    "limits",
    [{}, ALL_HOT, {"rows_per_task": 10, "sample": 1.0}],
    ids=["plain", "salted", "both"],
)
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_left_lookup(spark, many_partitions, settings, limits, broadcast):
    settings(spark__sql__autoBroadcastJoinThreshold=broadcast)
    pick = random.Random(5)
    left = [(pick.choice(["hot", "hot", None, *"abcxyz"]), n) for n in range(120)]
    right = [(pick.choice(["hot", None, *"abcde"]), f"v{n % 9}") for n in range(60)] + [("gone", "v")]
    found = left_lookup(
        spark.createDataFrame(left, "fk string, number int").repartition(3),
        spark.createDataFrame(right, "pk string, value string").repartition(3),
        "fk",
        "pk",
        **limits,
    )
    assert found.columns == ["fk", "number", "value"]
    assert rows_of(found) == joined_by_hand(left, right)


def test_lookup_sides_must_not_share_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="'b'"):
        left_lookup(df, df.withColumnRenamed("a", "c"), "a", "c")


def test_skewed_lookups_are_split_at_run_time(spark, settings):
    """Two lookups on one key that a third of the rows share: both joins must be split."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__shuffle__partitions="32",
    )
    rows = 60_000
    numbers = spark.range(0, rows, 1, 8)
    left = numbers.select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("fk"),
        F.md5(F.col("id").cast("string")).alias("text"),
    )
    doubled = numbers.select(F.col("id").alias("pk"), (F.col("id") * 2).alias("double"))
    tripled = numbers.select(F.col("id").alias("pk2"), (F.col("id") * 3).alias("triple"))
    df = left_lookup(left_lookup(left, doubled, "fk", "pk"), tripled, "fk", "pk2")
    found = df.collect()
    assert len(found) == rows
    assert all(r.double == 2 * r.fk and r.triple == 3 * r.fk for r in found)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("skew=true") == 2


def test_orphans(spark):
    rows = [("a", 1), ("b", 2), (None, 3), ("z", 4), ("z", 5)]
    df = spark.createDataFrame(rows, "id string, number int")
    ref = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    found = rows_of(orphan_rows(df, "id", ref, "id"))
    assert found == Counter([(None, 3), ("z", 4), ("z", 5)])
    assert orphan_counts(df, "id", ref, "id").first() == (5, 3)
    assert orphan_counts(df.where("false"), "id", ref, "id").first() == (0, 0)
    assert orphan_counts(df, "id", ref.where("false"), "id").first() == (5, 5)


def test_duplicates(spark):
    rows = [("a", 1), ("a", 1), ("a", None), ("a", None), ("a", None), (None, None), ("b", 1)]
    df = spark.createDataFrame(rows, "x string, y int")
    assert duplicate_counts(df, ["x", "y"]).first() == (7, 3)
    assert duplicate_counts(df, ["x"]).first() == (7, 4)
    assert duplicate_counts(df.where("false"), ["x"]).first() == (0, 0)


def test_hot_lookups_read_their_left_side_once(spark):
    facts = session.stage(spark.range(0, 200, 1, 4).select((F.col("id") % 5).alias("fk"), "id"), "facts")
    names = spark.createDataFrame([(n % 3, n % 5, f"v{n}") for n in range(300)], "a long, b long, v string")
    once = left_lookup(facts, names.select("a", "v"), "fk", "a", rows_per_task=20, sample=1.0)
    twice = left_lookup(
        once, names.select("b", F.col("v").alias("w")).limit(200), "fk", "b", rows_per_task=10, sample=1.0
    )
    plan = twice._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("id#") and len(re.findall(r"Relation \[fk#\d+L,id#\d+L\]", plan)) == 1
    counts = {r.fk: r.n for r in twice.groupBy("fk").agg(F.count("*").alias("n")).collect()}
    other = {r.b: r.n for r in names.limit(200).groupBy("b").agg(F.count("*").alias("n")).collect()}
    assert counts == {k: 40 * (100 if k < 3 else 1) * other[k] for k in range(5)}


def test_small_sides_are_not_searched(spark, monkeypatch):
    def search(*_):
        raise AssertionError("searched")

    monkeypatch.setattr("assay.operators.hot_keys.find_hot_keys", search)
    right = spark.createDataFrame([(1, "x")], "k int, v string")
    small = session.stage(right, "small")
    assert left_lookup(spark.range(3), small, "id", "k").count() == 3
