from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assay import functions as rules
from assay.functions.labels import (
    GENDERS,
    GENDERS_SPELLED_OUT,
    MARITAL_STATUSES,
    PRODUCT_LINES,
)
from assay.plans import silver


def values(spark, rows, schema, *rules_):
    """The rules' results, row by row, in the order of ``rows``."""
    numbered = [(number, *row) for number, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"number int, {schema}")
    found = df.select("number", *rules_).orderBy("number").collect()
    return [r[1] if len(rules_) == 1 else tuple(r[1:]) for r in found]


def test_dates_from_integers(spark):
    raw = [0, 5489, 20101229, 20101399, None, 20100230, 20120229, 19000229, 201012290, -1230101]
    found = values(spark, [(v,) for v in raw], "v int", rules.date_from_int(F.col("v")))
    assert found == [
        None, None, date(2010, 12, 29), None, None, None, date(2012, 2, 29), None, None, None,
    ]


def test_every_day_of_some_years_is_found(spark):
    days = spark.sql(
        "SELECT explode(sequence(DATE'1896-01-01', DATE'1904-12-31', INTERVAL 1 DAY)) AS day"
    ).withColumn("v", F.date_format("day", "yyyyMMdd").cast("int"))
    wrong = days.where(~rules.date_from_int(F.col("v")).eqNullSafe(F.col("day")))
    assert wrong.count() == 0


def test_dates_from_other_types(spark):
    text = values(spark, [("20101229",), ("x",), ("",)], "v string", rules.date_from_int(F.col("v")))
    assert text == [date(2010, 12, 29), None, None]
    large = values(spark, [(20101229,), (2**40,)], "v bigint", rules.date_from_int(F.col("v")))
    assert large == [date(2010, 12, 29), None]


SALES = [
    (2, None, 5), (2, -10, 5), (2, 11, 5), (2, 10, 5), (2, 7, None), (2, 10, -5), (2, None, -5),
    (0, 10, None), (2, None, None), (2, 0, 0), (None, 10, 5),
]


def test_amounts_and_prices_repair_each_other(spark):
    amount, quantity, price = F.col("s"), F.col("q"), F.col("p")
    found = values(
        spark,
        SALES,
        "q int, s int, p int",
        rules.reconciled_amount(amount, quantity, price),
        rules.clean_price(price, amount, quantity),
    )
    assert [a for a, _ in found] == [10, 10, 10, 10, 7, 10, 10, 10, None, 0, 10]
    # A price is derived from the amount as delivered, also where that amount is itself repaired.
    prices = [p if p is None else Decimal(p) for _, p in found]
    assert prices == [5, 5, 5, 5, Decimal("3.50"), 5, None, None, None, 0, 5]


def test_amounts_and_prices_against_a_direct_reading(spark):
    """Compare with the rules spelled out case by case on all small values."""
    some = [None, -6, -1, 0, 1, 2, 3, 6]
    rows = [(q, s, p) for q in some for s in some for p in some]

    def amount(q, s, p):
        expected = None if q is None or p is None else q * abs(p)
        if s is None or s <= 0 or (expected is not None and s != expected):
            return expected
        return s

    def price(q, s, p):
        if p is None or p <= 0:
            return None if s is None or not q else round(Decimal(s) / Decimal(q), 2)
        return Decimal(p)

    found = values(
        spark,
        rows,
        "q int, s int, p int",
        rules.reconciled_amount(F.col("s"), F.col("q"), F.col("p")),
        rules.clean_price(F.col("p"), F.col("s"), F.col("q")),
    )
    assert found == [(amount(*r), price(*r)) for r in rows]


def test_overflow_becomes_null_and_not_the_delivered_amount(spark):
    top = 2**31 - 1
    rows = [(top, 7, top), (1, top, None), (1, 5, -top - 1)]
    found = values(
        spark,
        rows,
        "q int, s int, p int",
        rules.reconciled_amount(F.col("s"), F.col("q"), F.col("p")),
        rules.clean_price(F.col("p"), F.col("s"), F.col("q")),
    )
    assert found[0][0] is None
    assert found[1] == (top, None)  # more than ten digits
    assert found[2] == (None, Decimal(5))


def test_types_of_the_sales_columns(spark):
    raw = spark.createDataFrame(
        [("a", "b", 1, 20200101, 0, 0, 5, 1, 5)],
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt int, "
        "sls_ship_dt int, sls_due_dt int, sls_sales int, sls_quantity int, sls_price int",
    )
    types = dict(silver.sales_details(raw).dtypes)
    assert types["sls_sales"] == "int"
    assert types["sls_price"] == "decimal(12,2)"
    assert types["sls_order_dt"] == "date"


def test_product_keys(spark):
    rows = [("CO-RF-FR-R92B-58",), ("AB-CD-X",), ("AB-CD",), (None,)]
    found = values(spark, rows, "k string", *rules.split_product_key(F.col("k")))
    assert found == [("CO_RF", "FR-R92B-58"), ("AB_CD", "X"), ("AB_CD", ""), (None, None)]


@pytest.mark.parametrize(
    "labels, codes, expected",
    [
        (
            PRODUCT_LINES,
            ["R ", " m", "S", "T", None, "", "X"],
            ["Road", "Mountain", "Other Sales", "Touring", "n/a", "n/a", "n/a"],
        ),
        (MARITAL_STATUSES, ["m", " S ", "x", None], ["Married", "Single", "n/a", "n/a"]),
        (GENDERS, ["f", "M ", "Male", None], ["Female", "Male", "n/a", "n/a"]),
        (
            GENDERS_SPELLED_OUT,
            ["M", " f ", "Male", "Female", None],
            ["Male", "Female", "Male", "Female", "n/a"],
        ),
        (GENDERS, ["M", " f ", "Male", "Female", None], ["Male", "Female", "n/a", "n/a", "n/a"]),
        (GENDERS, ["\tM", "M\r"], ["n/a", "n/a"]),
    ],
)
def test_labels(spark, labels, codes, expected):
    found = values(
        spark, [(c,) for c in codes], "c string", rules.code_label(F.col("c"), labels)
    )
    assert found == expected


def test_countries(spark):
    given = ["DE", "US", "USA", " DE ", "", "   ", None, " France ", "de"]
    found = values(spark, [(c,) for c in given], "c string", silver.country_name(F.col("c")))
    assert found == [
        "Germany", "United States", "United States", "Germany", "n/a", "n/a", "n/a", "France", "de",
    ]


def test_future_dates(spark):
    rows = [(date(1999, 12, 31),), (date(2000, 1, 1),), (date(2000, 1, 2),), (None,)]
    rule = rules.not_after(F.col("d"), F.lit(date(2000, 1, 1)))
    assert values(spark, rows, "d date", rule) == [rows[0][0], rows[1][0], None, None]


def test_demographics_default_to_today(spark):
    raw = spark.sql("""
        SELECT 'NASAW1' AS CID, current_date() AS BDATE, 'F' AS GEN
        UNION ALL SELECT 'AW2', date_add(current_date(), 2), 'Male'""")
    found = {r.CID: r for r in silver.customer_demographics(raw).collect()}
    assert found["AW1"].BDATE is not None and found["AW1"].GEN == "Female"
    assert found["AW2"].BDATE is None and found["AW2"].GEN == "Male"
    strict = silver.customer_demographics(raw, strict_codes=True).collect()
    assert {r.GEN for r in strict} == {"Female", "n/a"}


def test_ids(spark):
    rows = [("NASAW00011000",), ("AW-00011000",), ("AW00011000",), (None,)]
    found = values(
        spark,
        rows,
        "c string",
        rules.strip_text(F.col("c"), "NAS"),
        rules.strip_text(F.col("c"), "-"),
    )
    plain = "AW00011000"
    assert found == [
        (plain, "NASAW00011000"), ("AW-00011000", plain), (plain, plain), (None, None),
    ]


def test_gender_precedence(spark):
    rows = [("Male", "Female"), ("n/a", "Female"), ("n/a", None), ("n/a", "n/a"), (None, "Male")]
    found = values(
        spark, rows, "a string, b string", rules.preferred_label(F.col("a"), F.col("b"))
    )
    assert found == ["Male", "Female", "n/a", "n/a", "Male"]
