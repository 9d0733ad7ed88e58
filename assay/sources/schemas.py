"""Column names and types of the source exports and of the audit log. Fixed values."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
DATE, TIMESTAMP = DateType(), TimestampType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, data_type) for name, data_type in columns.items()])


SOURCE_SCHEMAS: dict[str, StructType] = {
    "crm_cust_info": _schema(
        cst_id=INT,
        cst_key=STRING,
        cst_firstname=STRING,
        cst_lastname=STRING,
        cst_marital_status=STRING,
        cst_gndr=STRING,
        cst_create_date=DATE,
    ),
    "crm_prd_info": _schema(
        prd_id=INT,
        prd_key=STRING,
        prd_nm=STRING,
        prd_cost=INT,
        prd_line=STRING,
        prd_start_dt=DATE,
        prd_end_dt=DATE,
    ),
    "crm_sales_details": _schema(
        sls_ord_num=STRING,
        sls_prd_key=STRING,
        sls_cust_id=INT,
        sls_order_dt=INT,
        sls_ship_dt=INT,
        sls_due_dt=INT,
        sls_sales=INT,
        sls_quantity=INT,
        sls_price=INT,
    ),
    "erp_cust_az12": _schema(CID=STRING, BDATE=DATE, GEN=STRING),
    "erp_loc_a101": _schema(CID=STRING, CNTRY=STRING),
    "erp_px_cat_g1v2": _schema(ID=STRING, CAT=STRING, SUBCAT=STRING, MAINTENANCE=STRING),
}

AUDIT_LOG = _schema(
    run_id=STRING,
    run_timestamp=TIMESTAMP,
    layer=STRING,
    table_name=STRING,
    check_name=STRING,
    check_type=STRING,
    status=STRING,
    severity=STRING,
    records_total=LONG,
    records_failed=LONG,
    failure_rate=DOUBLE,
    details=STRING,
    pipeline_run_id=STRING,
)
