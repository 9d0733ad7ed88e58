"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from assay.operators import left_lookup, with_surrogate_key, with_validity_end
from assay.plans import gold, silver
from assay.quality import QualityRunner
from assay.session import stage
from assay.sources import SOURCE_SCHEMAS

# Fixed value of the JVM: it does not compile methods with more bytes than this.
COMPILED_METHOD_LIMIT = 8000

RULES = {
    "crm_sales_details": silver.sales_details,
    "erp_cust_az12": silver.customer_demographics,
    "erp_loc_a101": silver.customer_locations,
    "erp_px_cat_g1v2": silver.product_categories,
}


@pytest.fixture
def explained(capsys):
    def explain(df, mode="simple"):
        capsys.readouterr()
        df.explain(mode)
        return capsys.readouterr().out

    return explain


def raw(spark, name):
    return stage(spark.createDataFrame([], SOURCE_SCHEMAS[name]), name)


@pytest.mark.parametrize("name", RULES)
def test_cleaning_stays_in_the_scan_stage(spark, explained, name):
    plan = explained(RULES[name](raw(spark, name)))
    assert "Exchange" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("name", RULES)
def test_cleaning_is_compiled(spark, explained, name):
    plan = explained(RULES[name](raw(spark, name)), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes
    assert max(sizes) < COMPILED_METHOD_LIMIT


def test_current_versions_are_filtered_in_the_scan(spark, explained, monkeypatch):
    monkeypatch.setattr(gold, "with_surrogate_key", lambda df, *_, **__: df)
    products = stage(silver.product_info(raw(spark, "crm_prd_info")), "products")
    plan = explained(gold.dim_products(products, raw(spark, "erp_px_cat_g1v2")))
    assert "PushedFilters: [IsNull(prd_end_dt)]" in plan


def test_checks_read_only_their_columns(spark, explained):
    sales = raw(spark, "crm_sales_details")
    runner = QualityRunner(spark, "bronze").check_nulls(sales, "sales", ["sls_cust_id"])
    plan = explained(runner.check_row_count(sales, "sales", 1).report())
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<sls_cust_id:int>" in plan


def test_keys_of_checks_are_grouped_before_the_shuffle(spark, explained):
    sales, products = raw(spark, "crm_sales_details"), raw(spark, "crm_prd_info")
    runner = QualityRunner(spark, "bronze")
    runner.check_referential_integrity(sales, "sales", "sls_prd_key", products, "prd_key")
    plan = explained(runner.report())
    for exchange in re.finditer(r"Exchange hashpartitioning\((\w+)#", plan):
        below = plan[exchange.end() : exchange.end() + 300]
        assert "HashAggregate" in below
    assert "ReadSchema: struct<sls_prd_key:string>" in plan


def test_validity_takes_one_shuffle(spark, explained):
    versions = raw(spark, "crm_prd_info").drop("prd_end_dt")
    plan = explained(with_validity_end(versions, ["prd_key"], "prd_start_dt", "end", ["prd_id"]))
    assert plan.count("Exchange") == 1


def test_numbering_has_no_window_over_rows(spark, explained):
    df = stage(spark.range(100).select((F.col("id") % 7).alias("k"), "id"), "rows")
    plan = explained(with_surrogate_key(df, "n", ["k"], ["id"]))
    windows = re.findall(r"Window \[(.*?)\]", plan)
    assert len(windows) == 1 and "_part" in windows[0]
    assert plan.count("SinglePartition") == 1  # the offsets


def test_a_large_dimension_is_hashed_not_sorted(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    facts = spark.range(0, 20_000, 1, 4).select((F.col("id") % 500).alias("fk"), "id")
    dimension = spark.range(500).select(F.col("id").alias("pk"), F.hash("id").alias("name"))
    df = left_lookup(facts, dimension, "fk", "pk")
    assert len(df.collect()) == 20_000
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ShuffledHashJoin" in final and "Sort " not in final
