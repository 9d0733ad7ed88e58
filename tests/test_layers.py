from collections import Counter
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assay.operators import with_surrogate_key
from assay.plans import layers
from assay.plans.names import Names
from assay.quality import QualityGateError, QualityRunner
from assay.session import shared_folder
from assay.sources import SOURCE_SCHEMAS, append_rows, overwrite_table, read_csv

FILES = {
    "crm/cust_info.csv": """
        cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date
        1,AW1, Ada ,Ash ,M,F,2020-01-01
        1,AW1, Ada ,Birch, s ,,2021-01-01
        2,AW2,Ben,Cole,,M,2020-05-05
        3,AW3,Cy,Dean,S,,2020-06-06
        ,AW9,Nobody,None,,,2020-07-07
        ,AW8,Nobody,None,,,2020-07-08""",
    "crm/prd_info.csv": """
        prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt
        10,CO-RF-FR-1,Frame,,R ,2011-07-01,2007-12-28
        11,CO-RF-FR-1,Frame,12,R ,2012-07-01,2008-12-27
        12,CO-RF-FR-1,Frame,14,R ,2013-07-01,
        13,CO-PE-PD-7,Pedal,5,,2013-07-01,
        14,AC-HE-HL-2,Helmet,7,S ,2003-07-01,""",
    "crm/sales_details.csv": """
        sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price
        SO1,FR-1,1,20101229,20110105,20110110,10,2,5
        SO2,PD-7,2,0,20110105,5489,,3,-4
        SO3,XX-0,3,20101229,20101399,20110110,9,3,
        SO4,HL-2,77,20101229,20110105,20110110,11,1,7
        SO5,HL-2,,20101229,20110105,20110110,7,1,7""",
    "erp/CUST_AZ12.csv": """
        CID,BDATE,GEN
        NASAW1,1970-01-01,Male
        AW2,2050-01-01,F
        NASAW3,1980-02-02,Female""",
    "erp/LOC_A101.csv": """
        CID,CNTRY
        AW-1,DE
        AW-2, US
        AW-8,""",
    "erp/PX_CAT_G1V2.csv": """
        ID,CAT,SUBCAT,MAINTENANCE
        CO_RF,Components,Road Frames,Yes
        CO_PD,Components,Pedals,No
        AC_HE,Accessories,Helmets,Yes""",
}


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    """The six exports as the source systems write them, with CRLF line ends."""
    folder = tmp_path_factory.mktemp("landing")
    for name, text in FILES.items():
        file = folder / name
        file.parent.mkdir(exist_ok=True)
        lines = [line.strip() for line in text.strip().splitlines()]
        file.write_bytes("\r\n".join([*lines, ""]).encode())
    return str(folder)


@pytest.fixture(scope="module")
def loaded(spark, landing):
    layers.run_all(spark, landing, as_of=date(2024, 1, 1))
    return spark


def table(spark, name):
    return Counter(tuple(r) for r in spark.table(name).collect())


def test_bronze_is_as_delivered(loaded):
    bronze = loaded.table("bronze.crm_cust_info")
    assert bronze.schema[:-1] == SOURCE_SCHEMAS["crm_cust_info"]
    assert bronze.columns[-1] == layers.CORRUPT_COLUMN and not bronze.where("_malformed is not null").count()
    assert bronze.count() == 6
    assert {r.cst_firstname for r in bronze.collect()} == {" Ada ", "Ben", "Cy", "Nobody"}
    assert table(loaded, "bronze.erp_loc_a101") == Counter(
        [("AW-1", "DE", None), ("AW-2", " US", None), ("AW-8", None, None)]
    )


def test_silver(loaded):
    day = date(2010, 12, 29)
    ship, due = date(2011, 1, 5), date(2011, 1, 10)
    assert table(loaded, "silver.crm_sales_details") == Counter([
        ("SO1", "FR-1", 1, day, ship, due, 10, 2, Decimal(5)),
        ("SO2", "PD-7", 2, None, ship, None, 12, 3, None),
        ("SO3", "XX-0", 3, day, None, due, 9, 3, Decimal(3)),
        ("SO4", "HL-2", 77, day, ship, due, 7, 1, Decimal(7)),
        ("SO5", "HL-2", None, day, ship, due, 7, 1, Decimal(7)),
    ])
    assert table(loaded, "silver.crm_prd_info") == Counter([
        (10, "FR-1", "CO_RF", "Frame", None, "Road", date(2011, 7, 1), date(2012, 6, 30)),
        (11, "FR-1", "CO_RF", "Frame", 12, "Road", date(2012, 7, 1), date(2013, 6, 30)),
        (12, "FR-1", "CO_RF", "Frame", 14, "Road", date(2013, 7, 1), None),
        (13, "PD-7", "CO_PE", "Pedal", 5, "n/a", date(2013, 7, 1), None),
        (14, "HL-2", "AC_HE", "Helmet", 7, "Other Sales", date(2003, 7, 1), None),
    ])
    assert table(loaded, "silver.crm_cust_info") == Counter([
        (1, "AW1", "Ada", "Birch", "Single", "n/a", date(2021, 1, 1)),
        (2, "AW2", "Ben", "Cole", "n/a", "Male", date(2020, 5, 5)),
        (3, "AW3", "Cy", "Dean", "Single", "n/a", date(2020, 6, 6)),
        (None, "AW8", "Nobody", "None", "n/a", "n/a", date(2020, 7, 8)),
    ])
    assert table(loaded, "silver.erp_cust_az12") == Counter([
        ("AW1", date(1970, 1, 1), "Male"), ("AW2", None, "Female"),
        ("AW3", date(1980, 2, 2), "Female"),
    ])
    assert table(loaded, "silver.erp_loc_a101") == Counter(
        [("AW1", "Germany"), ("AW2", "United States"), ("AW8", "n/a")]
    )
    assert loaded.table("silver.erp_px_cat_g1v2").count() == 3


def test_gold(loaded):
    assert table(loaded, "gold.dim_products") == Counter([
        (1, 12, "FR-1", "Frame", "CO_RF", "Road", "Components", "Road Frames", "Yes", 14,
         date(2013, 7, 1)),
        (2, 14, "HL-2", "Helmet", "AC_HE", "Other Sales", "Accessories", "Helmets", "Yes", 7,
         date(2003, 7, 1)),
        (3, 13, "PD-7", "Pedal", "CO_PE", "n/a", None, None, None, 5, date(2013, 7, 1)),
    ])
    assert table(loaded, "gold.dim_customers") == Counter([
        (1, 1, "AW1", "Ada", "Birch", "Single", "Male", "Germany", date(1970, 1, 1),
         date(2021, 1, 1)),
        (2, 2, "AW2", "Ben", "Cole", "n/a", "Male", "United States", None, date(2020, 5, 5)),
        (3, 3, "AW3", "Cy", "Dean", "Single", "Female", None, date(1980, 2, 2), date(2020, 6, 6)),
        (4, None, "AW8", "Nobody", "None", "n/a", "n/a", "n/a", None, date(2020, 7, 8)),
    ])
    keys = {r.order_number: (r.product_key, r.customer_key) for r in
            loaded.table("gold.fact_sales").collect()}
    assert keys == {
        "SO1": (1, 1), "SO2": (3, 2), "SO3": (None, 3), "SO4": (2, None), "SO5": (2, None),
    }


def test_a_second_run_gives_the_same_tables(loaded, landing):
    names = ["silver.crm_cust_info", "gold.dim_products", "gold.dim_customers", "gold.fact_sales"]
    before = {name: table(loaded, name) for name in names}
    layers.run_all(loaded, landing, as_of=date(2024, 1, 1))
    assert {name: table(loaded, name) for name in names} == before


def test_nothing_staged_is_left_behind(loaded, landing, tmp_path):
    def staged():
        return set(Path(shared_folder(loaded)).glob("assay-sorted-*"))

    kept = with_surrogate_key(loaded.table("gold.dim_products"), "n", ["product_key"])
    before = staged()
    assert before
    layers.transform(loaded, layers.gold_transformations(), at_once=1)
    layers.transform(loaded, layers.gold_transformations()[:2], at_once=2)
    assert staged() == before
    assert kept.count() == 3


def test_a_failure_among_several_at_once_is_raised(loaded):
    good = layers.Transformation("gold.one", "SELECT 1 AS one")
    bad = layers.Transformation("gold.two", "SELECT no_such_column")
    with pytest.raises(Exception, match="no_such_column"):
        layers.transform(loaded, [bad, good], at_once=2)
    assert table(loaded, "gold.one") == Counter([(1,)])


def test_lookup_keys_are_checked(loaded):
    silver = layers.check_lookup_keys(QualityRunner(loaded, "silver"))
    gold = layers.check_lookup_keys(QualityRunner(loaded, "gold"))
    assert [r["status"] for r in silver.results + gold.results] == ["PASSED"] * 5
    assert layers.check_lookup_keys(QualityRunner(loaded, "bronze")).results == []

    doubled = Names(prefix="doubled_")
    for name in ("erp_px_cat_g1v2", "erp_loc_a101", "erp_cust_az12"):
        rows = loaded.table(f"silver.{name}")
        loaded.sql("CREATE DATABASE IF NOT EXISTS doubled_silver")
        twice = rows.unionAll(rows) if name == "erp_loc_a101" else rows
        overwrite_table(twice, doubled.table("silver", name))
    found = layers.check_lookup_keys(QualityRunner(loaded, "silver"), doubled).results
    assert [(r["table_name"], r["records_failed"]) for r in found if r["status"] == "FAILED"] == [
        ("doubled_silver.erp_loc_a101", 3)
    ]


def test_lookups_keep_the_number_of_rows(loaded):
    counts = {name: loaded.table(name).count() for name in (
        "silver.crm_cust_info", "gold.dim_customers", "silver.crm_sales_details",
        "gold.fact_sales",
    )}
    assert list(counts.values()) == [4, 4, 5, 5]


def test_a_gate_stops_the_run(loaded, landing):
    seen = []

    def gate(spark, layer):
        seen.append(layer)
        if layer == "silver":
            sales = spark.table("silver.crm_sales_details")
            QualityRunner(spark, layer).check_nulls(sales, "sales", ["sls_cust_id"]).commit()

    with pytest.raises(QualityGateError):
        layers.run_all(loaded, landing, as_of=date(2024, 1, 1), gate=gate)
    assert seen == ["bronze", "silver"]
    assert loaded.table("audit.quality_log").where("table_name = 'sales'").count() == 1


def test_strict_codes_and_the_end_column_are_options(loaded, landing):
    steps = layers.silver_transformations(strict_codes=True, product_end_column="pd_end_dt")
    by_table = {step.destination: step.query(loaded) for step in steps}
    genders = {r.CID: r.GEN for r in by_table["silver.erp_cust_az12"].collect()}
    assert genders == {"AW1": "n/a", "AW2": "Female", "AW3": "n/a"}
    assert by_table["silver.crm_prd_info"].columns[-1] == "pd_end_dt"


def test_transformations_may_be_sql(loaded):
    layers.transform(loaded, [
        layers.Transformation(
            "gold.sales_by_product",
            "SELECT product_key, sum(sales_amount) AS amount FROM gold.fact_sales GROUP BY 1",
        ),
        layers.Transformation(
            "gold.best_product",
            "SELECT max(amount) AS amount FROM gold.sales_by_product",
        ),
    ])
    assert table(loaded, "gold.best_product") == Counter([(14,)])


def test_a_failing_query_leaves_the_table(loaded):
    before = table(loaded, "gold.dim_products")
    broken = layers.Transformation("gold.dim_products", "SELECT no_such_column FROM gold.fact_sales")
    with pytest.raises(Exception, match="no_such_column"):
        layers.transform(loaded, [broken])
    assert table(loaded, "gold.dim_products") == before


def test_names():
    below = Names(catalog="sales")
    assert layers.bronze_sources("/x/", below)[0].table == "sales.bronze.crm_cust_info"
    assert layers.bronze_sources("/x/")[0].path == "/x/crm/cust_info.csv"
    assert [s.destination for s in layers.gold_transformations(below)] == [
        "sales.gold.dim_products", "sales.gold.dim_customers", "sales.gold.fact_sales",
    ]
    assert Names(prefix="trial_").table("gold", "t") == "trial_gold.t"


def test_layers_may_live_in_a_folder_of_their_own(loaded, landing, tmp_path):
    names = Names(prefix="apart_")
    layers.run_all(
        loaded, landing, names, location=str(tmp_path), as_of=date(2024, 1, 1),
        product_end_column="pd_end_dt",
    )
    assert (tmp_path / "gold" / "fact_sales").is_dir()
    for name in ("dim_products", "dim_customers", "fact_sales"):
        assert table(loaded, f"apart_gold.{name}") == table(loaded, f"gold.{name}")


def test_schema_inference_is_an_option(loaded, landing):
    sources = {s.table: s for s in layers.bronze_sources(landing, infer_schema=True)}
    sales = read_csv(loaded, sources["bronze.crm_sales_details"].path)
    assert dict(sales.dtypes)["sls_order_dt"] == "int"
    products = read_csv(loaded, sources["bronze.crm_prd_info"].path)
    assert dict(products.dtypes)["prd_start_dt"] == "date"


def test_malformed_fields_become_null_and_may_be_kept(spark, tmp_path):
    file = tmp_path / "loc.csv"
    file.write_text("prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\n"
                    "x1,k,n,5,R,2020-01-01,\n2,k,n,,R,2020-01-01,\n")
    schema = SOURCE_SCHEMAS["crm_prd_info"]
    plain = read_csv(spark, str(file), schema)
    assert plain.columns == schema.names
    assert sorted(r.prd_id or 0 for r in plain.collect()) == [0, 2]
    kept = read_csv(spark, str(file), schema, corrupt_column="_bad").cache()
    assert [r._bad for r in kept.where("_bad IS NOT NULL").collect()] == ["x1,k,n,5,R,2020-01-01,"]
    kept.unpersist()


def test_a_wrong_header_is_an_error(spark, tmp_path):
    file = tmp_path / "loc.csv"
    file.write_text("CNTRY,CID\nDE,AW-1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(file), SOURCE_SCHEMAS["erp_loc_a101"]).collect()


def test_overwrite_and_append(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS scratch")
    first = spark.createDataFrame([(1, "x")], "a int, p string")
    overwrite_table(first, "scratch.t", partition_by=["p"])
    append_rows(spark.createDataFrame([("y", 2)], "p string, a int"), "scratch.t")
    assert table(spark, "scratch.t") == Counter([(1, "x"), (2, "y")])
    overwrite_table(spark.createDataFrame([(3.5,)], "other double"), "scratch.t", "orc")
    assert table(spark, "scratch.t") == Counter([(3.5,)])


def test_an_overwrite_that_fails_half_way_leaves_the_old_rows(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS scratch")
    overwrite_table(spark.createDataFrame([(1,)], "a int"), "scratch.kept")
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise("x").alias("a")
    )
    with pytest.raises(Exception, match="lost"):
        overwrite_table(broken, "scratch.kept")
    step = layers.Transformation("scratch.kept", lambda _: broken)
    with pytest.raises(Exception, match="lost"):
        layers.transform(spark, [step])
    assert table(spark, "scratch.kept") == Counter([(1,)])
    assert not [t.name for t in spark.catalog.listTables("scratch") if t.name.startswith("kept_new")]
    overwrite_table(spark.createDataFrame([("z",)], "b string"), "scratch.kept")
    assert table(spark, "scratch.kept") == Counter([("z",)])


def test_bronze_keeps_lines_its_schema_cannot_take(spark, landing, tmp_path):
    folder = tmp_path / "landing"
    for file, text in FILES.items():
        (folder / file).parent.mkdir(parents=True, exist_ok=True)
        lines = [x.strip() for x in text.strip().split("\n")]
        if file.endswith("sales_details.csv"):
            lines.append("SO6,HL-2,1,20101229,20110105,20110110,3000000000,1,19.98")
        (folder / file).write_text("\n".join(lines) + "\n")
    names = Names(prefix="dirty_")
    layers.run_all(spark, str(folder), names, as_of=date(2024, 1, 1), product_end_column="pd_end_dt")
    sales = spark.table("dirty_bronze.crm_sales_details")
    kept = [r._malformed for r in sales.where("_malformed is not null").collect()]
    assert kept == ["SO6,HL-2,1,20101229,20110105,20110110,3000000000,1,19.98"]
    runner = layers.check_malformed(QualityRunner(spark, "bronze"), names)
    failed = {r["table_name"]: r["records_failed"] for r in runner.results if r["records_failed"]}
    assert failed == {"dirty_bronze.crm_sales_details": 1}
    assert runner.has_critical_failure
    inferred = Names(prefix="inferred_")
    layers.run_all(
        spark, str(folder), inferred, as_of=date(2024, 1, 1), product_end_column="pd_end_dt",
        infer_schema=True,
    )
    fact = spark.table("inferred_gold.fact_sales").where("order_number = 'SO6'")
    assert fact.select("sales_amount").first()[0] is not None
