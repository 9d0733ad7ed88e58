"""``workload/exports.py`` and the layers in SQL, as common table expressions.

The codes, labels, column names and the rule for amounts are fixed values: the results must have them.
"""

from __future__ import annotations


def spoiled_sql(day: str, quantity: str) -> str:
    return f"""CASE {quantity} WHEN 13 THEN 0 WHEN 17 THEN 5489 WHEN 19 THEN 20101399
        ELSE CAST(strftime({day}, '%Y%m%d') AS INTEGER) END"""


def date_sql(column: str) -> str:
    return f"""CASE WHEN length(CAST({column} AS VARCHAR)) = 8
        THEN CAST(try_strptime(CAST({column} AS VARCHAR), '%Y%m%d') AS DATE) END"""


def _half_up(amount: str, quantity: str) -> str:
    """amount / quantity to two places, exactly, half away from zero."""
    cents = f"((abs({amount}) * 200 + {quantity}) // (2 * {quantity}))"
    return f"CAST(sign({amount}) * {cents} AS DECIMAL(12,0)) / 100"


def price(column: str, amount: str, quantity: str) -> str:
    return f"""CAST(CASE WHEN {column} > 0 THEN {column}
        WHEN {quantity} <> 0 THEN {_half_up(amount, quantity)} END AS DECIMAL(12,2))"""


EXPORTS = {
    "sales": f"""
        SELECT 'SO' || l_orderkey AS sls_ord_num,
          CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'ZZ-P0'
            ELSE 'FR-P' || lpad(CAST(l_partkey // 3 AS VARCHAR), 9, '0') END AS sls_prd_key,
          CAST(CASE WHEN l_linenumber = 6 AND o_orderpriority = '5-LOW' THEN NULL
            ELSE o_custkey END AS INTEGER) AS sls_cust_id,
          {spoiled_sql("o_orderdate", "q")} AS sls_order_dt,
          {spoiled_sql("l_shipdate", "q + 10")} AS sls_ship_dt,
          {spoiled_sql("(CAST(l_shipdate AS DATE) + 7)", "q - 10")} AS sls_due_dt,
          CASE WHEN l_linenumber = 1 AND l_returnflag = 'A' THEN q * p + 1
            WHEN l_linenumber = 2 AND l_returnflag = 'N' THEN NULL
            WHEN l_linenumber = 3 THEN NULL
            WHEN l_linenumber = 4 THEN -q * p
            WHEN l_linenumber = 5 THEN q * p + 1
            ELSE q * p END AS sls_sales,
          CASE WHEN l_linenumber = 1 AND l_discount > 0.08 THEN 0
            WHEN l_linenumber <= 4 AND l_discount < 0.02 THEN NULL ELSE q END AS sls_quantity,
          CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN -p
            WHEN l_linenumber >= 5 AND l_tax > 0.07 THEN 2000000000 ELSE p END AS sls_price
        FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q,
                CAST(floor(l_extendedprice / 100) AS INTEGER) AS p FROM lineitem)
        JOIN orders ON l_orderkey = o_orderkey""",
    "products": """
        SELECT CAST(p_partkey AS INTEGER) AS prd_id,
          'NA-' || lpad(CAST(p_partkey // 3 % 30 AS VARCHAR), 2, '0') || '-FR-P'
            || lpad(CAST(p_partkey // 3 AS VARCHAR), 9, '0') AS prd_key,
          p_name AS prd_nm,
          CAST(CASE WHEN p_type <> 'PROMO' THEN floor(p_retailprice) END AS INTEGER) AS prd_cost,
          CASE p_type WHEN 'ECONOMY' THEN 'R ' WHEN 'LARGE' THEN ' m' WHEN 'MEDIUM' THEN 'S'
            WHEN 'SMALL' THEN 't' WHEN 'STANDARD' THEN '' END AS prd_line,
          DATE '1995-01-01' + p_size AS prd_start_dt
        FROM part""",
    "categories": """
        SELECT 'NA_' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS ID, r_name AS CAT,
          n_name AS SUBCAT, CASE r_name WHEN 'ASIA' THEN 'Yes' ELSE 'No' END AS MAINTENANCE
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": """
        SELECT CAST(CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
            ELSE o_custkey END AS INTEGER) AS cst_id,
          'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cst_key,
          '  ' || c_name || ' ' AS cst_firstname, c_mktsegment || ' ' AS cst_lastname,
          CASE o_orderstatus WHEN 'F' THEN ' m' WHEN 'O' THEN 's ' ELSE 'X' END
            AS cst_marital_status,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'm' WHEN '2-HIGH' THEN ' F '
            WHEN '3-MEDIUM' THEN NULL ELSE '' END AS cst_gndr,
          CAST(o_orderdate AS DATE) AS cst_create_date
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "demographics": """
        SELECT CASE c_mktsegment WHEN 'FURNITURE' THEN 'NASXX' WHEN 'HOUSEHOLD' THEN ''
            ELSE 'NAS' END || 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CID,
          DATE '1950-01-01' + CAST(floor(c_acctbal * 2) AS INTEGER) AS BDATE,
          CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'M' WHEN 'BUILDING' THEN ' f '
            WHEN 'FURNITURE' THEN 'Male' WHEN 'HOUSEHOLD' THEN 'Female' END AS GEN
        FROM customer""",
    "locations": """
        SELECT 'AW-' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CID,
          CASE n_name WHEN 'NATION_0' THEN 'DE' WHEN 'NATION_1' THEN 'USA'
            WHEN 'NATION_2' THEN 'US' WHEN 'NATION_3' THEN ' DE ' WHEN 'NATION_4' THEN ''
            WHEN 'NATION_5' THEN '   ' WHEN 'NATION_6' THEN NULL WHEN 'NATION_7' THEN 'de'
            ELSE n_name END AS CNTRY
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
}

LAYERS = {
    "silver_sales": f"""
        SELECT sls_ord_num, sls_prd_key, sls_cust_id,
          {date_sql("sls_order_dt")} AS sls_order_dt, {date_sql("sls_ship_dt")} AS sls_ship_dt,
          {date_sql("sls_due_dt")} AS sls_due_dt,
          TRY_CAST(CASE WHEN sls_sales IS NULL OR sls_sales <= 0
              OR sls_sales <> CAST(sls_quantity AS BIGINT) * abs(sls_price)
            THEN CAST(sls_quantity AS BIGINT) * abs(sls_price) ELSE sls_sales END AS INTEGER)
            AS sls_sales,
          sls_quantity, {price("sls_price", "sls_sales", "sls_quantity")} AS sls_price
        FROM sales""",
    "silver_products": """
        SELECT prd_id, substr(prd_key, 7) AS prd_key,
          replace(left(prd_key, 5), '-', '_') AS cat_id, prd_nm, prd_cost,
          CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road'
            WHEN 'S' THEN 'Other Sales' WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS prd_line,
          prd_start_dt,
          CAST(lead(prd_start_dt) OVER (
            PARTITION BY products.prd_key ORDER BY prd_start_dt, prd_id) - 1 AS DATE) AS prd_end_dt
        FROM products""",
    "silver_customers": """
        SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname,
          trim(cst_lastname) AS cst_lastname,
          CASE upper(trim(cst_marital_status)) WHEN 'M' THEN 'Married' WHEN 'S' THEN 'Single'
            ELSE 'n/a' END AS cst_marital_status,
          CASE upper(trim(cst_gndr)) WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female'
            ELSE 'n/a' END AS cst_gndr,
          cst_create_date
        FROM customers
        QUALIFY row_number() OVER (PARTITION BY customers.cst_id ORDER BY
          customers.cst_create_date DESC NULLS LAST, customers.cst_key DESC NULLS LAST,
          customers.cst_firstname DESC NULLS LAST, customers.cst_lastname DESC NULLS LAST,
          customers.cst_marital_status DESC NULLS LAST, customers.cst_gndr DESC NULLS LAST) = 1""",
    "silver_demographics": """
        SELECT replace(CID, 'NAS', '') AS CID,
          CASE WHEN BDATE <= DATE '2000-01-01' THEN BDATE END AS BDATE,
          CASE upper(trim(GEN)) WHEN 'M' THEN 'Male' WHEN 'MALE' THEN 'Male'
            WHEN 'F' THEN 'Female' WHEN 'FEMALE' THEN 'Female' ELSE 'n/a' END AS GEN
        FROM demographics""",
    "silver_locations": """
        SELECT replace(CID, '-', '') AS CID,
          CASE coalesce(trim(CNTRY), '') WHEN '' THEN 'n/a' WHEN 'DE' THEN 'Germany'
            WHEN 'US' THEN 'United States' WHEN 'USA' THEN 'United States'
            ELSE trim(CNTRY) END AS CNTRY
        FROM locations""",
    "dim_products": """
        SELECT CAST(row_number() OVER (ORDER BY prd_key, prd_start_dt, prd_id) AS BIGINT)
            AS product_key,
          prd_id AS product_id, prd_key AS product_number, prd_nm AS product_name, cat_id,
          prd_line AS product_line, CAT AS category, SUBCAT AS subcategory,
          MAINTENANCE AS maintenance, prd_cost AS cost, prd_start_dt AS start_date
        FROM silver_products LEFT JOIN categories ON cat_id = ID
        WHERE prd_end_dt IS NULL""",
    "dim_customers": """
        SELECT CAST(row_number() OVER (
            ORDER BY cst_key, cst_create_date, cst_id NULLS FIRST) AS BIGINT) AS customer_key,
          cst_id AS customer_id, cst_key AS customer_number, cst_firstname AS first_name,
          cst_lastname AS last_name, cst_marital_status AS marital_status,
          CASE WHEN cst_gndr = 'n/a' THEN coalesce(GEN, 'n/a') ELSE cst_gndr END AS gender,
          CNTRY AS country, BDATE AS birth_date, cst_create_date AS create_date
        FROM silver_customers
        LEFT JOIN silver_locations l ON cst_key = l.CID
        LEFT JOIN silver_demographics d ON cst_key = d.CID""",
    "fact_sales": """
        SELECT sls_ord_num AS order_number, product_key, customer_key,
          sls_order_dt AS order_date, sls_ship_dt AS shipping_date, sls_due_dt AS due_date,
          sls_sales AS sales_amount, sls_quantity AS quantity, sls_price AS price
        FROM silver_sales
        LEFT JOIN dim_products ON sls_prd_key = product_number
        LEFT JOIN dim_customers ON sls_cust_id = customer_id""",
}

# What each layer table reads.
NEEDS = {
    "silver_sales": ["sales"],
    "silver_products": ["products"],
    "silver_customers": ["customers"],
    "silver_demographics": ["demographics"],
    "silver_locations": ["locations"],
    "dim_products": ["silver_products", "categories"],
    "dim_customers": ["silver_customers", "silver_locations", "silver_demographics"],
    "fact_sales": ["silver_sales", "dim_products", "dim_customers"],
}


def select_from(*tables: str, query: str | None = None) -> str:
    """``query`` (or all rows of the one table) below the expressions its tables need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in tables:
        add(name)
    bodies = {**EXPORTS, **LAYERS}
    clauses = ",\n".join(f"{name} AS ({bodies[name]})" for name in ordered)
    return f"WITH {clauses}\n{query or f'SELECT * FROM {tables[0]}'}"
