"""CSV exports as DataFrames.

Every file of a folder has a header row of its own, and no column is taken by its place alone. ``read_csv`` parses with a schema's types; ``read_text`` keeps all fields as text, from
which ``typed`` makes columns that are as wide as their values need.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# What a whole number may be widened to, in this order, when values need it.
WIDER: tuple[DataType, ...] = (IntegerType(), LongType(), DecimalType(23, 4), DoubleType())

ONE_FILE_EACH = {
    "spark.sql.files.maxPartitionBytes": str(1 << 50),
    "spark.sql.files.openCostInBytes": str(1 << 50),
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    corrupt_column: str | None = None,
    any_order: bool = False,
) -> DataFrame:
    """A CSV file or folder with header rows; an empty field is NULL.

    With a schema the data is read once, in splits, and each file's header must name the schema's
    columns: in its order, or in ``any_order`` of its own. A malformed field becomes NULL; name a ``corrupt_column`` to keep its whole
    line there. Without a schema Spark infers one, which costs a pass over the data and may change
    type between loads; the first header counts for all files.
    """
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    names = [*schema.names, *([corrupt_column] if corrupt_column else [])]
    parts = []
    for header, files in _headers(spark, path, schema.names, any_order).items():
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
        fields = [schema[name] for name in header]
        if corrupt_column:
            fields.append(StructField(corrupt_column, StringType()))
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        # Spark checks the header of each file once more as it reads it.
        reader = reader.option("enforceSchema", False).schema(StructType(fields))
        parts.append(reader.csv(files or path).select(*names))
    return reduce(DataFrame.unionByName, parts)


def read_text(
    spark: SparkSession,
    path: str,
    columns: list[str],
    corrupt_column: str | None = None,
    any_order: bool = True,
) -> DataFrame:
    """The same with all columns as text."""
    text = StructType([StructField(name, StringType()) for name in columns])
    return read_csv(spark, path, text, corrupt_column, any_order)


def typed(
    text: DataFrame,
    schema: StructType,
    types: Mapping[str, DataType] | None = None,
    corrupt_column: str | None = None,
    rejects_column: str | None = None,
) -> DataFrame:
    """Columns of text cast to the schema's types, or to ``types`` where these name a wider one.

    A line with a value that the schema itself cannot hold is kept in ``corrupt_column``. What no
    column could take is kept in ``rejects_column``: a map from column to text, NULL if all fitted.
    """
    wide = dict(types or {})
    cast = {f.name: _cast(F.col(f.name), wide.get(f.name, f.dataType)) for f in schema}
    out = [cast[f.name].alias(f.name) for f in schema]
    parsed = [f for f in schema if not isinstance(f.dataType, StringType)]
    if corrupt_column:
        beyond = _any(F.col(f.name).isNotNull() & _cast(F.col(f.name), f.dataType).isNull() for f in parsed)
        # kept as it was written, but for quotes that were not needed
        as_it_is = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        line = F.to_csv(F.struct(*schema.names), as_it_is)
        known = F.col(corrupt_column) if corrupt_column in text.columns else F.lit(None)
        out.append(F.coalesce(known, F.when(beyond, line)).alias(corrupt_column))
    if rejects_column:
        lost = [
            F.when(F.col(f.name).isNotNull() & cast[f.name].isNull(), _entry(f.name))
            for f in parsed
        ]
        entries = F.array_compact(F.array(*lost, F.when(F.lit(False), _entry(schema.names[0]))))
        kept = F.map_from_entries(entries)
        out.append(F.when(F.size(entries) > 0, kept).alias(rejects_column))
    return text.select(*out)


def widths(schema: StructType) -> dict[str, Column]:
    """For each column of whole numbers, an aggregate over its text: the place in ``WIDER`` it needs."""
    return {
        f.name: F.coalesce(F.max(_width(F.col(f.name), WIDER.index(f.dataType))), F.lit(0))
        for f in schema
        if f.dataType in WIDER[:-1]
    }


def wider_types(schema: StructType, needed: Mapping[str, int]) -> dict[str, DataType]:
    """The types that values of these widths need, where the schema's do not do."""
    return {
        name: WIDER[width]
        for name, width in needed.items()
        if width > WIDER.index(schema[name].dataType)
    }


def _width(text: Column, least: int) -> Column:
    """Exact in the type, and in none before it. What is no number needs nothing."""
    width = F.when(text.isNull() | _cast(text, WIDER[least]).isNotNull(), least)
    for place in range(least + 1, len(WIDER)):
        width = width.when(_cast(text, WIDER[place]).isNotNull(), place)
    return width.otherwise(least)


def _cast(text: Column, kind: DataType) -> Column:
    value = text.try_cast(kind)
    if isinstance(kind, DecimalType):
        same = value.cast("double") == text.try_cast("double")
        return F.when(same, value)  # a cast would round
    if isinstance(kind, DoubleType):
        return F.when(F.abs(value) < float("inf"), value)
    return value


def _entry(name: str) -> Column:
    return F.struct(F.lit(name).alias("key"), F.col(name).alias("value"))


def _any(conditions) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def _headers(
    spark: SparkSession, path: str, wanted: list[str], any_order: bool
) -> dict[tuple[str, ...], list[str]]:
    """Each order of the columns that files have, and the files; no list if one order is all.

    One task a file reads its first line. Files without a line do not count. The answer is as long as
    Spark's own listing of the folder at most, and one row if all headers are alike.
    """
    with _settings(spark, ONE_FILE_EACH):
        lines = spark.read.text(path).select(
            "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
        )
        first = lines.mapInArrow(_first_line, "header string, file string")
        counted = first.groupBy("header").agg(F.count(F.lit(1)).alias("files")).collect()
        orders: dict[tuple[str, ...], list[str]] = {}
        for row in counted:
            order = tuple(next(csv.reader([row.header])))
            if (sorted(order) != sorted(wanted)) if any_order else (list(order) != wanted):
                some = first.where(F.col("header") == row.header).select("file").first()[0]
                raise ValueError(
                    f"the CSV header of {row.files} files in {path} is {list(order)}, not {wanted}: {some}"
                )
            orders.setdefault(order, [])
        if not orders:
            raise ValueError(f"no CSV header in {path}")
        if len(orders) > 1:
            for row in first.collect():
                orders[tuple(next(csv.reader([row.header])))].append(row.file)
    return orders


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of the file, if the task has its beginning; the rest is not read."""
    for batch in batches:
        if batch.num_rows:
            if batch.column("start")[0].as_py() == 0:
                line = batch.slice(0, 1)
                yield pa.record_batch([line.column("value"), line.column("file")], ["header", "file"])
            return


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings for the jobs inside; a session's own come back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
