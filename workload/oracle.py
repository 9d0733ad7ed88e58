"""The same queries in SQL, for DuckDB."""

from __future__ import annotations

from workload.exports_sql import date_sql, select_from, spoiled_sql

_CHECK_SQL = {
    "row_count": """
        SELECT 'orders' AS table_name, 'row_count_min' AS check_name,
          'completeness' AS check_type, severity, n AS records_total,
          CASE WHEN n >= least_rows THEN 0 ELSE n END AS records_failed, n >= least_rows AS passed,
          '{"min_expected":' || least_rows || ',"actual":' || n || '}' AS details
        FROM (SELECT count(*) AS n FROM orders),
          (VALUES (1, 'CRITICAL'), (1000000000, 'HIGH')) AS t(least_rows, severity)""",
    "nulls": """
        SELECT 'crm_sales_details' AS table_name, 'null_check_' || name AS check_name,
          'completeness' AS check_type, severity, n AS records_total, missing AS records_failed,
          missing <= n * threshold AS passed, CAST(NULL AS VARCHAR) AS details,
          name AS column_name, CAST(threshold AS DOUBLE) AS threshold
        FROM (SELECT count(*) AS n, count(*) - count(sls_ord_num) AS a,
            count(*) - count(sls_order_dt) AS b, count(*) - count(sls_cust_id) AS c,
            count(*) - count(sls_price) AS d FROM silver_sales),
          LATERAL (VALUES ('sls_ord_num', a, 0.0, 'CRITICAL'), ('sls_order_dt', b, 0.0, 'CRITICAL'),
            ('sls_cust_id', c, 0.0, 'CRITICAL'), ('sls_price', d, 0.0, 'CRITICAL'),
            ('sls_order_dt', b, 0.5, 'HIGH')) AS t(name, missing, threshold, severity)""",
    "duplicates": """
        SELECT table_name, check_name, 'uniqueness' AS check_type, 'CRITICAL' AS severity,
          n AS records_total, n - keys AS records_failed, n = keys AS passed,
          '{"key_columns":' || listed || ',"duplicate_count":' || (n - keys) || '}' AS details
        FROM (
          SELECT 'lineitem' AS table_name, 'duplicate_check_l_orderkey_l_linenumber' AS check_name,
            '["l_orderkey","l_linenumber"]' AS listed, count(*) AS n,
            (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS keys
          FROM lineitem
          UNION ALL
          SELECT 'orders', 'duplicate_check_o_orderkey', '["o_orderkey"]', count(*),
            count(DISTINCT o_orderkey)
          FROM orders)""",
    "value_set": """
        SELECT 'orders' AS table_name, 'value_set_o_orderstatus' AS check_name,
          'validity' AS check_type, 'HIGH' AS severity, n AS records_total, bad AS records_failed,
          bad = 0 AS passed,
          '{"column":"o_orderstatus","valid_values":' || listed || '}' AS details
        FROM (SELECT count(*) AS n,
            count(*) FILTER (o_orderpriority <> '5-LOW' AND o_orderstatus NOT IN ('F', 'O')) AS a,
            count(*) FILTER (o_orderpriority <> '5-LOW' AND o_orderstatus NOT IN ('F', 'O', 'P'))
              AS b FROM orders),
          LATERAL (VALUES ('["F","O"]', a), ('["F","O","P"]', b)) AS t(listed, bad)""",
    "references": """
        SELECT table_name, 'ref_integrity_' || fk AS check_name, 'consistency' AS check_type,
          'HIGH' AS severity, n AS records_total, bad AS records_failed, bad = 0 AS passed,
          '{"fk_column":"' || fk || '","pk_column":"' || pk || '"}' AS details
        FROM (
          SELECT 'documents' AS table_name, 'doc_id' AS fk, 'doc_id' AS pk, count(*) AS n,
            count(*) FILTER (NOT EXISTS (
              SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS bad
          FROM documents d
          UNION ALL
          SELECT 'crm_sales_details', 'sls_cust_id', 'c_custkey', count(*),
            count(*) FILTER (NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = sls_cust_id))
          FROM sales
          UNION ALL
          SELECT 'lineitem', 'l_partkey', 'p_partkey', count(*),
            count(*) FILTER (NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey))
          FROM lineitem)""",
}

_CHECK_NEEDS = {"nulls": ["silver_sales"], "references": ["sales"]}


def _checks(columns: str, *names: str, tail: str = "") -> str:
    union = "\nUNION ALL BY NAME\n".join(f"({_CHECK_SQL[n]})" for n in names)
    needed = [table for n in names for table in _CHECK_NEEDS.get(n, [])]
    query = f"""SELECT {columns} FROM (
      SELECT * EXCLUDE (records_total, records_failed),
        CAST(records_total AS BIGINT) AS records_total,
        CAST(records_failed AS BIGINT) AS records_failed,
        CASE WHEN passed THEN 'PASSED' ELSE 'FAILED' END AS status,
        CASE WHEN records_total = 0 THEN 0.0
          ELSE CAST(records_failed AS DOUBLE) / records_total END AS failure_rate
      FROM ({union})) {tail}"""
    return select_from(*needed, query=query) if needed else query


_COLUMNS = (
    "table_name, check_name, check_type, status, severity, records_total, records_failed, "
    "CAST(failure_rate AS DOUBLE) AS failure_rate"
)
_ALL = list(_CHECK_SQL)

ORACLE: dict[str, str] = {
    "layers_end_to_end": select_from("fact_sales"),
    "layers_sql_transform": """
        SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey""",
    "layers_reload": select_from("silver_locations"),
    "layers_dim_products": select_from("dim_products"),
    "layers_dim_customers": select_from("dim_customers"),
    "bronze_csv_scan": select_from("sales"),
    "bronze_dirty_csv": """
        SELECT CAST(l_orderkey AS INTEGER) AS order_key, CAST(l_linenumber AS INTEGER) AS line,
          CASE l_linenumber WHEN 7 THEN q + 3000000000 WHEN 5 THEN NULL ELSE q END AS quantity,
          CAST(CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'R' THEN floor(p) ELSE p END
            AS DECIMAL(23,4)) AS price,
          CASE WHEN l_linenumber <> 4 THEN CAST(l_shipdate AS DATE) END AS shipped,
          l_returnflag AS flag, l_returnflag <> 'R' OR l_linenumber >= 4 AS malformed,
          CASE l_linenumber WHEN 5 THEN 'many' END AS quantity_rejected,
          CASE l_linenumber WHEN 6 THEN 'free, today' END AS price_rejected,
          CASE l_linenumber WHEN 4 THEN 'soon' END AS shipped_rejected
        FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS p
              FROM lineitem)""",
    "silver_category_passthrough": select_from("categories"),
    "silver_date_key": f"""
        SELECT l_orderkey, l_linenumber, raw, {date_sql("raw")} AS day
        FROM (SELECT l_orderkey, l_linenumber,
                {spoiled_sql("l_shipdate", "CAST(l_quantity AS INTEGER)")} AS raw FROM lineitem)""",
    "silver_sales_repair": f"""
        SELECT l_orderkey, l_linenumber,
          CAST(CASE WHEN price IS NULL THEN CASE WHEN amount > 0 THEN amount END
            ELSE q * abs(price) END AS DECIMAL(18,2)) AS amount,
          CAST(CASE WHEN price > 0 THEN price ELSE whole / 100 END AS DECIMAL(12,2)) AS price
        FROM (
          SELECT *, CAST(sign(amount) * ((abs(CAST(amount * 100 AS BIGINT)) * 2 + q) // (2 * q))
            AS DECIMAL(18,0)) AS whole
          FROM (
            SELECT l_orderkey, l_linenumber, q,
              CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN -(q * full_price)
                WHEN 3 THEN q * full_price + 1 ELSE q * full_price END AS amount,
              CASE l_linenumber WHEN 4 THEN NULL WHEN 5 THEN -full_price
                ELSE full_price END AS price
            FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q,
                    CAST(l_extendedprice AS DECIMAL(12,2)) AS full_price FROM lineitem)))""",
    "silver_product_key_split": select_from(
        "products",
        query="""SELECT prd_id, replace(left(prd_key, 5), '-', '_') AS cat_id,
          substr(prd_key, 7) AS prd_key FROM products""",
    ),
    "silver_code_labels": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Mountain' WHEN 'O' THEN 'Road'
          ELSE 'n/a' END AS label FROM orders""",
    "silver_gender_label": select_from(
        "demographics",
        query="""SELECT CID,
          CASE lower(trim(GEN)) WHEN 'm' THEN 'Male' WHEN 'male' THEN 'Male' WHEN 'f' THEN 'Female'
            WHEN 'female' THEN 'Female' ELSE 'n/a' END AS gender,
          CASE lower(trim(GEN)) WHEN 'm' THEN 'Male' WHEN 'f' THEN 'Female' ELSE 'n/a' END
            AS gender_strict
          FROM demographics""",
    ),
    "silver_country_standardise": select_from(
        "locations",
        query="""SELECT CID, CASE coalesce(trim(CNTRY), '') WHEN '' THEN 'n/a'
          WHEN 'DE' THEN 'Germany' WHEN 'US' THEN 'United States' WHEN 'USA' THEN 'United States'
          ELSE trim(CNTRY) END AS country FROM locations""",
    ),
    "silver_future_date_null": """
        SELECT o_orderkey, CASE WHEN o_orderdate < DATE '2000-01-02'
          THEN CAST(o_orderdate AS DATE) END AS day FROM orders""",
    "silver_id_clean": """
        SELECT c_custkey, 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS without_prefix,
          replace('AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || c_mktsegment || c_name,
            '-', '') AS without_dashes
        FROM customer""",
    "silver_latest_per_key": """
        SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped, l_partkey, l_suppkey
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "silver_validity_interval": """
        SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS valid_from,
          CAST(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey
            ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS DATE) AS valid_to
        FROM orders""",
    "silver_validity_of_times": """
        SELECT event_id, user_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS valid_from,
          CAST(CAST(lead(moment) OVER (PARTITION BY user_id ORDER BY moment NULLS FIRST, event_id)
            AS DATE) - 1 AS DATE) AS valid_to
        FROM (SELECT event_id, CASE WHEN event_type <> 'click' THEN user_id END AS user_id,
                CASE WHEN event_id % 97 <> 0 THEN ts + to_seconds(event_id % 86400) END AS moment
              FROM events)""",
    "silver_crm_sales_details": select_from("silver_sales"),
    "silver_crm_prd_info": select_from("silver_products"),
    "silver_crm_cust_info": select_from("silver_customers"),
    "silver_erp_cust_az12": select_from("silver_demographics"),
    "silver_erp_loc_a101": select_from("silver_locations"),
    "gold_surrogate_key": """
        SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_key,
          CAST(o_orderdate AS DATE) AS ordered, o_orderkey
        FROM orders""",
    "gold_dim_products": select_from("dim_products"),
    "gold_dim_customers": select_from("dim_customers"),
    "gold_source_precedence": """
        SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Female'
            WHEN 'MACHINERY' THEN 'Male'
            ELSE CASE WHEN s_acctbal > 5000 THEN 'Female' WHEN s_acctbal > 1000 THEN 'Male'
              ELSE 'n/a' END END AS gender
        FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
    "gold_fact_sales": select_from("fact_sales"),
    "dq_row_count": _checks(f"{_COLUMNS}, details", "row_count"),
    "dq_nulls": _checks(
        f"{_COLUMNS}, column_name, CAST(failure_rate AS DOUBLE) AS null_rate, threshold", "nulls"
    ),
    "dq_checked_write": _checks(
        f"{_COLUMNS}, column_name, CAST(failure_rate AS DOUBLE) AS null_rate, threshold", "nulls"
    ),
    "dq_raising_commit": _checks(
        f"{_COLUMNS}, column_name, CAST(failure_rate AS DOUBLE) AS null_rate, threshold", "nulls"
    ),
    "dq_duplicates": _checks(f"{_COLUMNS}, details", "duplicates"),
    "dq_value_set": _checks(f"{_COLUMNS}, details", "value_set"),
    "dq_ref_integrity": _checks(f"{_COLUMNS}, details", "references"),
    "dq_orphan_rows": """
        SELECT doc_id, lang, source FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "dq_audit_log": _checks(
        f"""'run-1' AS run_id, 946684800::BIGINT AS run_timestamp, layer,
          'manual' AS pipeline_run_id, {_COLUMNS}, details""",
        "row_count",
        "value_set",
        tail=", (VALUES ('bronze'), ('silver')) AS layers(layer)",
    ),
    "dq_truncated_log": _checks(
        f"'run-1' AS run_id, 'silver' AS layer, 'manual' AS pipeline_run_id, {_COLUMNS}, details",
        "value_set",
    ),
    "dq_run_summary": _checks(
        """'run-1' AS run_id, 'silver' AS layer, table_name,
          CAST(count(*) FILTER (passed) AS BIGINT) AS passed,
          CAST(count(*) FILTER (NOT passed) AS BIGINT) AS failed""",
        *_ALL,
        tail="GROUP BY table_name",
    ),
    "dq_alerts": _checks(
        """'silver' AS layer, 'run-1' AS run_id,
          946684800::BIGINT AS run_timestamp, 'manual' AS pipeline_run_id,
          table_name, check_name, check_type, status, severity,
          records_failed || ' / ' || records_total AS failed_of_total,
          CASE WHEN NOT starts_with(check_name, 'null_check') THEN details END AS details""",
        *_ALL,
        tail="WHERE NOT passed",
    ),
}
