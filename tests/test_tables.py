"""Loads under names that readers use meanwhile, and CSV files as they come."""

import threading
from collections import Counter
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from assay.operators import hot_keys, left_lookup
from assay.plans import layers
from assay.plans.names import Names
from assay.quality import QualityRunner
from assay.sources import append_rows, create_schema, drop_table, overwrite_table, read_csv, tables, truncate
from test_layers import FILES, landing  # noqa: F401


@pytest.fixture(scope="module")
def schema(spark):
    spark.sql("CREATE DATABASE loads")
    yield "loads"
    spark.sql("DROP DATABASE loads CASCADE")


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a int")


def held(spark, name):
    return sorted(r[0] for r in spark.table(name).collect())


def versions(spark, name):
    return [t for t in tables._versions(spark, name) if spark.catalog.tableExists(t)]


@pytest.mark.parametrize("name", ["loads.two", "spark_catalog.loads.three", "one_part"])
def test_names_of_one_two_and_three_parts(spark, schema, name):
    for k in range(4):
        overwrite_table(rows(spark, k, k + 1), name)
        assert held(spark, name) == [k, k + 1]
    append_rows(rows(spark, 9), name)
    assert held(spark, name) == [3, 4, 9]
    assert len(versions(spark, name)) == 2  # the present load, and the one before for readers at work
    truncate(spark, name)
    assert held(spark, name) == []
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and not versions(spark, name)


def test_schema_format_and_partitions_may_change(spark, schema):
    overwrite_table(rows(spark, 1), "loads.changing")
    other = spark.createDataFrame([("x", 1.5)], "p string, b double")
    overwrite_table(other, "loads.changing", "orc", partition_by=["p"])
    assert spark.table("loads.changing").dtypes == [("b", "double"), ("p", "string")]
    overwrite_table(spark.table("loads.changing").union(spark.table("loads.changing")), "loads.changing")
    assert spark.table("loads.changing").count() == 2


@pytest.mark.parametrize("step", ["_load", "_point", "shown_version", "_forget", "_versions"])
def test_a_failure_at_any_step_leaves_rows(spark, schema, monkeypatch, step):
    name = f"spark_catalog.loads.failing{step}"
    overwrite_table(rows(spark, 1), name)
    overwrite_table(rows(spark, 2), name)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, step, broken)
        try:
            overwrite_table(rows(spark, 3), name)
        except RuntimeError:
            pass
    after_the_switch = step in ("_forget", "_versions")
    assert held(spark, name) == ([3] if after_the_switch else [2])
    overwrite_table(rows(spark, 4), name)
    overwrite_table(rows(spark, 5), name)
    assert held(spark, name) == [5] and len(versions(spark, name)) == 2


def test_readers_never_miss_the_table(spark, schema):
    name, seen, stop = "loads.busy", [], threading.Event()
    overwrite_table(rows(spark, 0, 0), name)

    def read():
        other = spark.newSession()
        while not stop.is_set():
            try:
                seen.append(tuple(r[0] for r in other.table(name).collect()))
            except Exception as error:
                seen.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 7):
        overwrite_table(rows(spark, k, k), name)
    stop.set()
    reader.join()
    assert len(seen) > 3 and all(isinstance(s, tuple) and len(s) == 2 and s[0] == s[1] for s in seen), seen


def test_a_table_made_otherwise_is_replaced(spark, schema, monkeypatch):
    for name in ("loads.plain", "spark_catalog.loads.plain_three"):
        rows(spark, 1).write.saveAsTable(name)
        with monkeypatch.context() as patched:
            patched.setattr(tables, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                overwrite_table(rows(spark, 2), name)
        assert held(spark, name) == [1]
        for k in (2, 3, 4):
            overwrite_table(rows(spark, k), name)
            assert held(spark, name) == [k]
        drop_table(spark, name)
    rows(spark, 1).write.saveAsTable("loads.dropped")
    drop_table(spark, "loads.dropped")
    assert not spark.catalog.tableExists("loads.dropped")


def test_tables_of_similar_names_are_left_alone(spark, schema):
    rows(spark, 7).write.saveAsTable("loads.t__v")
    rows(spark, 8).write.saveAsTable("loads.t__vat_2020")
    for k in range(3):
        overwrite_table(rows(spark, k), "loads.t")
    drop_table(spark, "loads.t")
    assert held(spark, "loads.t__v") == [7] and held(spark, "loads.t__vat_2020") == [8]


def test_files_of_dropped_loads_go(spark, schema):
    for k in range(4):
        overwrite_table(rows(spark, k), "loads.files")
    place = Path(spark.catalog.getDatabase("loads").locationUri.removeprefix("file:")) / "files"
    assert len(list(place.iterdir())) == 2


def test_a_second_run_under_a_catalog(spark, landing):  # noqa: F811
    names = Names("spark_catalog", "twice_")
    found = []
    for _ in range(2):
        layers.run_all(spark, landing, names, as_of=date(2024, 1, 1))
        gold = [names.table("gold", t) for t in ("dim_products", "dim_customers", "fact_sales")]
        found.append([Counter(map(tuple, spark.table(t).collect())) for t in gold])
    assert found[0] == found[1] and sum(found[0][2].values()) == 5


def test_notes_stand_as_long_as_their_rows(spark, schema):
    name, text = "spark_catalog.loads.noted", "[[\"it's \\\\ here\", 3]]"
    overwrite_table(rows(spark, 1), name, notes=lambda: {"k": text})
    assert tables.note(spark, name, "k") == text
    overwrite_table(rows(spark, 2), name)
    assert tables.note(spark, name, "k") is None
    assert tables.note(spark, "loads.no_such", "k") is None


def test_hot_keys_are_noted_while_their_table_is_written(spark, schema, monkeypatch):
    """And no job looks for them when the table is looked up."""
    monkeypatch.setattr(hot_keys.to_note, "__defaults__", (100,))
    values = [("hot", k) for k in range(400)] + [(f"k{k}", k) for k in range(300)] + [(None, 1)] * 200
    right = spark.createDataFrame(values, "pk string, v int").repartition(5)
    step = layers.Transformation("loads.looked_up", lambda _: right, lookup_key="pk")
    layers.transform(spark, [step])
    found = tables.note(spark, "loads.looked_up", "hot.pk")
    assert found == '[["hot", 400]]'
    left = spark.createDataFrame([("hot", 1), ("k7", 2), ("none", 3), (None, 4)], "fk string, n int")
    plain = left_lookup(left, spark.table("loads.looked_up"), "fk", "pk", hot_note="[]")

    def no_search(*args, **kwargs):
        raise AssertionError("searched")

    monkeypatch.setattr(hot_keys, "find_hot_keys", no_search)
    salted = left_lookup(left, spark.table("loads.looked_up"), "fk", "pk", 100, hot_note=found)
    assert "_salt" in salted._jdf.queryExecution().toString()
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))
    assert salted.count() == 403


def test_a_run_looks_for_no_hot_keys(spark, landing, monkeypatch):  # noqa: F811
    searched = []
    search = hot_keys.find_hot_keys
    monkeypatch.setattr(hot_keys, "find_hot_keys", lambda df, keys, *a: searched.append(keys) or search(df, keys, *a))
    monkeypatch.setattr(hot_keys, "may_hold_hot_keys", lambda df: True)
    layers.run_all(spark, landing, Names(prefix="noted_"), as_of=date(2024, 1, 1))
    assert searched == [["prd_key"]]  # the versions of a product, which no table is looked up by
    assert tables.note(spark, "noted_gold.dim_customers", "hot.customer_id") == "[]"


# CSV

KINDS = StructType([
    StructField("n", IntegerType()), StructField("amount", IntegerType()),
    StructField("day", DateType()), StructField("name", StringType()),
])


def files(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def loaded(spark, path, table, **options):
    create_schema(spark, "csvs")
    source = layers.CsvSource(path, f"csvs.{table}", KINDS, "_bad", "_lost", **options)
    layers.load_csv(spark, [source])
    return spark.table(source.table)


def test_columns_go_by_each_files_header(spark, tmp_path):
    path = files(
        tmp_path / "in", a="n,amount,day,name\n1,2,2020-01-01,x\n", empty="", none="name,day,n,amount\n",
        b='name,day,n,amount\n"y, z",2021-01-01,3,4\r\n', c="n,amount,day,name\n5,6,,\n",
    )
    got = loaded(spark, path, "orders").orderBy("n").collect()
    assert [tuple(r) for r in got] == [
        (1, 2, date(2020, 1, 1), "x", None, None), (3, 4, date(2021, 1, 1), "y, z", None, None),
        (5, 6, None, None, None, None),
    ]
    with pytest.raises(ValueError, match="header.*'name', 'day'"):
        read_csv(spark, path, KINDS)
    with pytest.raises(ValueError, match="header.*'name', 'day'"):
        read_csv(spark, path, KINDS, "_bad")
    assert read_csv(spark, path, KINDS, any_order=True).count() == 3


def test_headers_that_do_not_fit_are_refused(spark, tmp_path):
    for k, header in enumerate(["n,amount,day", "n,amount,day,name,more", "n,amount,day,day", "N,amount,day,name"]):
        path = files(tmp_path / str(k), a="n,amount,day,name\n1,2,,\n", b=f"{header}\n1,2,,\n")
        with pytest.raises(ValueError, match="header of 1 files"):
            read_csv(spark, path, KINDS, any_order=True)
    with pytest.raises(ValueError, match="no CSV header"):
        read_csv(spark, files(tmp_path / "none", a=""), KINDS)


def test_settings_come_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    read_csv(spark, files(tmp_path / "in", a="n,amount,day,name\n"), KINDS)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


@pytest.mark.parametrize("transaction", [False, True])
def test_no_value_is_emptied_by_its_type(spark, tmp_path, monkeypatch, transaction):
    if transaction:
        monkeypatch.setattr(layers, "in_place", lambda *a: True)
    text = "n,amount,day,name\n1,3000000000,2020-01-01,x\n2,19.98,2020-13-01,y\n3, 7 ,,\nfour,-5,,z\n"
    got = loaded(spark, files(tmp_path / "in", a=text), f"wide_{transaction}")
    assert dict(got.dtypes)["amount"] == "decimal(23,4)" and dict(got.dtypes)["n"] == "int"
    assert {(r.n, r.amount, r.day) for r in got.collect()} == {
        (1, Decimal(3_000_000_000), date(2020, 1, 1)), (2, Decimal("19.98"), None), (3, Decimal(7), None),
        (None, Decimal(-5), None),
    }
    assert {(r.name, r._bad, str(r._lost)) for r in got.where("_bad IS NOT NULL").collect()} == {
        ("x", "1,3000000000,2020-01-01,x", "None"), ("y", "2,19.98,2020-13-01,y", "{'day': '2020-13-01'}"),
        ("z", "four,-5,,z", "{'n': 'four'}"),
    }


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "2"], "int"), (["2147483647", "x"], "int"), (["2147483648"], "bigint"),
        (["1.5"], "decimal(23,4)"), (["1.5", "9223372036854775807"], "decimal(23,4)"),
        (["0.12345"], "double"), (["1.5", "1e30"], "double"),
        (["1e300"], "double"), (["1e400", "NaN", "Infinity"], "int"), (["", ""], "int"),
    ],
)
def test_columns_are_as_wide_as_needed(spark, tmp_path, values, kind):
    text = "n,amount,day,name\n" + "".join(f"1,{v},,\n" for v in values)
    got = loaded(spark, files(tmp_path / "in", a=text), "widths")
    assert dict(got.dtypes)["amount"] == kind
    numbers = [v for v in values if v.strip() and kind != "int" or v.isdigit()]
    kept = [float(r.amount) for r in got.collect() if r.amount is not None]
    assert sorted(kept) == sorted(float(v) for v in numbers)


def test_wide_values_reach_gold(spark, tmp_path):
    for file, text in FILES.items():
        lines = [x.strip() for x in text.strip().split("\n")]
        if file.endswith("sales_details.csv"):
            lines.append("SO6,HL-2,1,20101229,20110105,20110110,3000000000,1,")
            lines.append("SO7,HL-2,3000000000,20101229,20110105,20110110,,2,19.98")
        (tmp_path / file).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / file).write_text("\n".join(lines) + "\n")
    names = Names(prefix="wide_")
    layers.run_all(spark, str(tmp_path), names, as_of=date(2024, 1, 1))
    fact = {r.order_number: r for r in spark.table("wide_gold.fact_sales").collect()}
    assert fact["SO6"].sales_amount == 3_000_000_000 and fact["SO6"].customer_key == 1
    assert (fact["SO7"].sales_amount, fact["SO7"].price) == (Decimal("39.96"), Decimal("19.98"))
    assert spark.table("wide_silver.crm_sales_details").where("sls_cust_id = 3000000000").count() == 1
    runner = layers.check_malformed(QualityRunner(spark, "bronze"), names)
    assert sum(r["records_failed"] for r in runner.results) == 2
