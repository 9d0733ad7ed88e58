import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from assay.quality import (
    QualityGateError,
    QualityRunner,
    alerts,
    create_log,
    run_summary,
    truncate_log,
)

LOG = "audit.quality_log"


@pytest.fixture
def log(spark):
    create_log(spark)
    truncate_log(spark)
    return lambda: spark.table(LOG)


@pytest.fixture
def people(spark):
    rows = [(1, "a", "F"), (1, "a", None), (2, None, "M"), (None, None, "x"), (None, None, "x")]
    return spark.createDataFrame(rows, "id int, name string, sex string")


@pytest.fixture
def nobody(people):
    return people.where("false")


def only(runner):
    (result,) = runner.results
    return result


def counts(result):
    return (
        result["check_name"],
        result["status"],
        result["records_total"],
        result["records_failed"],
        result["failure_rate"],
    )


def test_row_count(spark, people, nobody):
    def check(df, least):
        return only(QualityRunner(spark, "bronze").check_row_count(df, "people", least))

    assert counts(check(people, 5)) == ("row_count_min", "PASSED", 5, 0, 0.0)
    failed = check(people, 6)
    assert counts(failed) == ("row_count_min", "FAILED", 5, 5, 1.0)
    assert (failed["severity"], failed["check_type"]) == ("CRITICAL", "completeness")
    assert json.loads(failed["details"]) == {"min_expected": 6, "actual": 5}
    assert counts(check(nobody, 0)) == ("row_count_min", "PASSED", 0, 0, 0.0)
    assert counts(check(nobody, 1)) == ("row_count_min", "FAILED", 0, 0, 0.0)


def test_nulls(spark, people, nobody):
    runner = QualityRunner(spark, "bronze").check_nulls(people, "people", ["id", "name"], 0.5)
    assert [counts(r) for r in runner.results] == [
        ("null_check_id", "PASSED", 5, 2, 0.4),
        ("null_check_name", "FAILED", 5, 3, 0.6),
    ]
    details = json.loads(runner.results[1]["details"])
    assert details == {"column": "name", "null_rate": 0.6, "threshold": 0.5}
    empty = QualityRunner(spark, "bronze").check_nulls(nobody, "people", ["id"])
    assert counts(only(empty)) == ("null_check_id", "PASSED", 0, 0, 0.0)


def test_duplicates(spark, people, nobody):
    runner = QualityRunner(spark, "bronze").check_duplicates(people, "people", ["id", "name"])
    result = only(runner)
    assert counts(result) == ("duplicate_check_id_name", "FAILED", 5, 2, 0.4)
    assert result["check_type"] == "uniqueness"
    assert json.loads(result["details"]) == {"key_columns": ["id", "name"], "duplicate_count": 2}
    empty = QualityRunner(spark, "bronze").check_duplicates(nobody, "people", ["id"])
    assert counts(only(empty)) == ("duplicate_check_id", "PASSED", 0, 0, 0.0)


def test_values_in_set(spark, people):
    runner = QualityRunner(spark, "silver").check_values_in_set(people, "people", "sex", ["F", "M"])
    result = only(runner)
    assert counts(result) == ("value_set_sex", "FAILED", 5, 2, 0.4)
    assert (result["severity"], result["check_type"]) == ("HIGH", "validity")
    assert json.loads(result["details"]) == {"column": "sex", "valid_values": ["F", "M"]}


def test_referential_integrity(spark, people):
    ref = spark.createDataFrame([(1,), (1,), (7,)], "id int")
    runner = QualityRunner(spark, "gold").check_referential_integrity(
        people, "people", "id", ref, "id"
    )
    result = only(runner)
    assert counts(result) == ("ref_integrity_id", "FAILED", 5, 3, 0.6)
    assert (result["severity"], result["check_type"]) == ("HIGH", "consistency")
    assert json.loads(result["details"]) == {"fk_column": "id", "pk_column": "id"}


def test_checks_on_one_dataframe_share_a_scan(spark, people, capsys):
    runner = QualityRunner(spark, "bronze")
    runner.check_row_count(people, "people", 1).check_nulls(people, "people", ["id", "name"])
    runner.check_values_in_set(people, "people", "sex", ["F"])
    runner.report().explain()
    plan = capsys.readouterr().out
    assert plan.count("Scan ExistingRDD") == 1
    names = [r["check_name"] for r in runner.results]
    assert names == ["row_count_min", "null_check_id", "null_check_name", "value_set_sex"]


def test_one_table_read_twice_is_scanned_once(spark, people, capsys):
    people.write.mode("overwrite").saveAsTable("default.people")
    runner = QualityRunner(spark, "bronze")
    runner.check_row_count(spark.table("default.people"), "people", 1)
    runner.check_nulls(spark.table("default.people"), "people", ["id"])
    others = spark.table("default.people").where("id IS NULL")
    runner.check_nulls(others, "others", ["id"], severity="LOW")
    renamed = spark.table("default.people").withColumnRenamed("id", "number")
    runner.check_nulls(renamed, "renamed", ["number"])
    capsys.readouterr()
    runner.report().explain()
    assert capsys.readouterr().out.count("FileScan") == 3
    assert [(r["records_total"], r["records_failed"]) for r in runner.results] == [
        (5, 0), (5, 2), (2, 2), (5, 2),
    ]


def test_results_keep_the_order_of_declaration(spark, people):
    runner = (
        QualityRunner(spark, "bronze", table_name="people")
        .check_duplicates(people, key_columns=["id"])
        .check_row_count(people, min_rows=1)
        .check_nulls(people, "other", ["name"])
    )
    assert [(r["table_name"], r["check_type"]) for r in runner.results] == [
        ("people", "uniqueness"), ("people", "completeness"), ("other", "completeness"),
    ]
    runner.check_row_count(people, min_rows=2)
    assert len(runner.results) == 4


def test_commit_saves_before_it_raises(spark, people, log):
    when = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    runner = QualityRunner(
        spark, "silver", run_id="r1", pipeline_run_id="nightly", run_timestamp=when
    )
    runner.check_row_count(people, "people", 100)
    with pytest.raises(QualityGateError, match="silver.*people"):
        runner.commit()
    (row,) = log().collect()
    assert (row.run_id, row.layer, row.status) == ("r1", "silver", "FAILED")
    assert row.pipeline_run_id == "nightly"
    assert row.run_timestamp.timestamp() == when.timestamp()


def test_commits_append_once_each(spark, people, log):
    runner = QualityRunner(spark, "bronze").check_row_count(people, "people", 1)
    assert runner.pipeline_run_id == "manual"
    assert len(runner.commit()) == 1
    assert runner.commit() == []
    assert log().count() == 1
    QualityRunner(spark, "gold").check_row_count(people, "people", 1).commit()
    assert {(r.layer, r.status) for r in log().collect()} == {
        ("bronze", "PASSED"), ("gold", "PASSED"),
    }
    truncate_log(spark)
    assert log().count() == 0


def test_only_critical_failures_raise(spark, people, log):
    high = QualityRunner(spark, "bronze").check_values_in_set(people, "people", "sex", ["F"])
    assert not high.has_critical_failure
    high.commit()
    critical = QualityRunner(spark, "bronze").check_nulls(people, "people", ["id"])
    assert critical.has_critical_failure
    assert critical.commit(raise_on_critical=False)[0]["status"] == "FAILED"
    mild = QualityRunner(spark, "bronze").check_nulls(people, "people", ["id"], severity="LOW")
    mild.commit()
    assert log().count() == 3


def test_log_is_partitioned_by_layer(spark, log):
    assert log().columns[-1] == "layer"
    described = spark.sql(f"DESCRIBE TABLE {LOG}").collect()
    assert "# Partition Information" in [r.col_name for r in described]


def test_alerts_go_to_the_sink(spark, people, log):
    sent = []
    runner = QualityRunner(
        spark,
        "bronze",
        alert_emails=["someone"],
        alert_sink=lambda failures, to: sent.append((failures.collect(), to)),
    )
    runner.check_row_count(people, "people", 1).check_row_count(people, "people", 9)
    runner.commit(raise_on_critical=False)
    ((rows, to),) = sent
    assert to == ["someone"]
    assert [(r.check_name, r.failed_of_total) for r in rows] == [("row_count_min", "5 / 5")]
    assert len(rows[0]) == 11
    assert (rows[0].layer, rows[0].run_id) == ("bronze", runner.run_id)

    QualityRunner(spark, "bronze", alert_sink=lambda *_: sent.append(_)).check_row_count(
        people, "people", 1
    ).commit()
    assert len(sent) == 1


def test_a_broken_sink_does_not_fail_the_run(spark, people, log):
    def broken(*_):
        raise OSError("no connection")

    runner = QualityRunner(spark, "bronze", alert_sink=broken)
    runner.check_row_count(people, "people", 9).commit(raise_on_critical=False)
    assert log().count() == 1


def test_summary_and_alerts_of_the_log(spark, people, log):
    for run in ("r1", "r2"):
        runner = QualityRunner(spark, "bronze", run_id=run)
        runner.check_nulls(people, "people", ["id", "name", "sex"], 0.5)
        runner.commit(raise_on_critical=False)
    summary = {(r.run_id, r.table_name): (r.passed, r.failed) for r in run_summary(log()).collect()}
    assert summary == {("r1", "people"): (2, 1), ("r2", "people"): (2, 1)}
    assert [r.check_name for r in alerts(log()).collect()] == ["null_check_name"] * 2


def test_a_runner_without_checks_commits_nothing(spark, log):
    assert QualityRunner(spark, "bronze").commit() == []
    assert log().count() == 0


def test_a_failed_save_keeps_the_results_for_the_next_commit(spark, people, log, monkeypatch):
    runner = QualityRunner(spark, "bronze").check_row_count(people, "people", 9)

    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr("assay.quality.runner.append_rows", broken)
        with pytest.raises(OSError):
            runner.commit()
    with pytest.raises(QualityGateError):
        runner.commit()
    assert log().count() == 1
    assert runner.commit() == []


def test_checks_of_nothing_are_refused(spark, people):
    runner = QualityRunner(spark, "bronze")
    for declare in (
        lambda: runner.check_nulls(people, "people"),
        lambda: runner.check_duplicates(people, "people"),
        lambda: runner.check_values_in_set(people, "people", "sex"),
        lambda: runner.check_values_in_set(people, "people", valid_values=["m"]),
    ):
        with pytest.raises(ValueError):
            declare()


def test_the_logged_time_is_the_given_one(spark, people, log):
    at = datetime(2024, 10, 27, 0, 30, tzinfo=timezone.utc)  # an hour that some zones have twice
    QualityRunner(spark, "bronze", run_timestamp=at).check_row_count(people, "people").commit()
    assert log().where(F.col("run_timestamp") == F.lit(at)).count() == 1
