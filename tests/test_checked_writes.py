"""Checks that count while a table is written, and commits that can be repeated."""

import pytest
from pyspark.sql import functions as F

from assay.plans import layers
from assay.quality import QualityGateError, QualityRunner, create_log, truncate_log
from assay.quality import runner as runner_module
from assay.sources import create_schema, overwrite_table

LOG = "audit.quality_log"


@pytest.fixture
def log(spark):
    create_log(spark)
    truncate_log(spark)
    create_schema(spark, "checked")
    return lambda: spark.table(LOG)


@pytest.fixture
def people(spark):
    rows = [(1, "a", "F"), (1, "a", None), (2, None, "M"), (None, None, "x"), (None, None, "x")]
    return spark.createDataFrame(rows, "id int, name string, sex string").repartition(3)


def every_check(runner, df):
    runner.check_row_count(df, "people", 1)
    runner.check_row_count(df, "people", 99, severity="HIGH")
    runner.check_nulls(df, "people", ["id", "name", "sex"], 0.3)
    runner.check_duplicates(df, "people", ["id"])
    runner.check_values_in_set(df, "people", "sex", ["F", "M"])
    runner.check_values_in_set(df, "people", "sex", ["x"])
    runner.check_referential_integrity(df, "people", "id", df.where("id = 1"), "id")


def entries(runner):
    return [{k: v for k, v in r.items() if k != "run_timestamp"} for r in runner.results]


@pytest.mark.parametrize("rows", ["all", "none"])
def test_checks_of_a_write_log_what_checks_of_the_table_do(spark, people, log, rows):
    df = people if rows == "all" else people.where("false")
    checked = QualityRunner(spark, "silver", run_id="r")
    step = layers.Transformation("checked.people", lambda _: df, every_check)
    layers.transform(spark, [step], runner=checked)
    plain = QualityRunner(spark, "silver", run_id="r")
    every_check(plain, df)
    assert spark.table("checked.people").count() == df.count()
    assert len(entries(checked)) == 9 and entries(checked) == entries(plain)


def test_plain_counts_cost_no_scan_of_their_own(spark, people, log):
    """Each row of the query is made once: a counter in it says so."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = people.mapInArrow(count, people.schema)
    runner = QualityRunner(spark, "silver")
    step = layers.Transformation(
        "checked.once", lambda _: df, lambda r, d: r.check_nulls(d, "once", ["id", "sex"]).check_row_count(d, "once", 1)
    )
    layers.transform(spark, [step], runner=runner)
    assert [r["records_failed"] for r in runner.results] == [2, 1, 0]
    assert made.value == 5


def test_several_steps_at_once(spark, people, log):
    runner = QualityRunner(spark, "silver")
    steps = [
        layers.Transformation(
            f"checked.t{k}", lambda _, k=k: people.where(F.coalesce("id", F.lit(0)) <= k),
            lambda r, d, k=k: r.check_row_count(d, f"t{k}", 1),
        )
        for k in range(3)
    ]
    layers.transform(spark, steps, at_once=3, runner=runner)
    assert {r["table_name"]: r["records_total"] for r in runner.results} == {"t0": 2, "t1": 4, "t2": 5}


def test_a_failing_write_declares_nothing(spark, people, log):
    runner = QualityRunner(spark, "silver")
    broken = people.withColumn("id", F.raise_error(F.lit("lost")).cast("int"))
    step = layers.Transformation("checked.broken", lambda _: broken, every_check)
    with pytest.raises(Exception, match="lost"):
        layers.transform(spark, [step], runner=runner)
    assert runner.results == []


def test_checks_that_change_between_calls_are_refused(spark, people, log):
    names = iter(["id", "name"])
    runner = QualityRunner(spark, "silver")
    with pytest.raises(ValueError, match="same checks"):
        runner.check_while_writing(
            people, lambda r, d: r.check_nulls(d, "t", [next(names)]),
            lambda d: overwrite_table(d, "checked.t"), lambda: spark.table("checked.t"),
        )


def test_a_repeated_run_logs_once_and_still_raises(spark, people, log):
    """As after a driver that was lost between the append and the end of the commit."""
    for attempt in range(3):
        runner = QualityRunner(spark, "silver", run_id="nightly-1")
        every_check(runner, people)
        with pytest.raises(QualityGateError):
            runner.commit()
        assert log().count() == 9, attempt
    other = QualityRunner(spark, "gold", run_id="nightly-1")  # another layer, another run
    every_check(other, people)
    other.commit(raise_on_critical=False)
    every_check(new := QualityRunner(spark, "silver", run_id="nightly-2"), people)
    new.commit(raise_on_critical=False)
    assert log().count() == 27


def test_a_half_saved_run_is_completed(spark, people, log):
    first = QualityRunner(spark, "silver", run_id="n")
    first.check_nulls(people, "people", ["id"])
    first.commit(raise_on_critical=False)
    again = QualityRunner(spark, "silver", run_id="n")
    again.check_nulls(people, "people", ["id", "name"])
    again.check_nulls(people, "people", ["id"], 0.9)
    again.commit(raise_on_critical=False)
    found = sorted((r.check_name, r.status) for r in log().collect())
    assert found == [
        ("null_check_id", "FAILED"), ("null_check_id", "PASSED"), ("null_check_name", "FAILED"),
    ]


def test_one_runner_may_commit_the_same_check_again(spark, people, log):
    runner = QualityRunner(spark, "silver", run_id="n")
    for _ in range(2):
        runner.check_row_count(people, "people", 1).commit()
    assert log().count() == 2


def test_a_failed_save_of_a_given_run_is_repeated(spark, people, log, monkeypatch):
    runner = QualityRunner(spark, "silver", run_id="n").check_row_count(people, "people", 1)
    with monkeypatch.context() as patched:
        patched.setattr(runner_module, "append_rows", lambda *a: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError):
            runner.commit()
    assert log().count() == 0
    runner.commit()
    assert log().count() == 1
