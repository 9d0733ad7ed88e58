"""What the operators share: splits by document id, batches of texts, and bounded broadcasts."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 512

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


_shipped: str | None = None  # the application that has this package


def prepare(spark: SparkSession) -> None:
    """Send this package to the workers, and hand them rows in small batches.

    A batch of long texts must fit a worker's memory, whence the batch size.
    """
    global _shipped
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if _shipped == context.applicationId:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped = context.applicationId


def id_class(key: Column, classes: int) -> Column:
    """crc32 of the id as text, modulo ``classes``. A null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % classes


def texts(array: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in array.cast(pa.binary()).to_pylist()]


_kept: tuple[str, Any] | None = None


def kept(name: str, make: Callable[[], Any]) -> Any:
    """What a worker keeps for its later tasks: one thing, until an operator of another kind starts."""
    global _kept
    if _kept is None or _kept[0] != name:
        _kept = (name, make())
    return _kept[1]


def records(
    iterator: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS, keeps: str | None = None
) -> Iterator[pa.RecordBatch]:
    """The batches without empty ones, in slices of at most ``rows``.

    What the worker keeps for other operators than ``keeps`` goes first: workers serve one stage after
    the other, and their memory has to do for each.
    """
    global _kept
    if _kept is not None and _kept[0] != keeps:
        _kept = None
        pa.default_memory_pool().release_unused()
    for batch in iterator:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()  # the worker stays, and serves other stages


def bounded(df: DataFrame, size: Column, most: int, what: str) -> list:
    """Collect a small table once its total ``size`` is known to be at most ``most`` bytes."""
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    if total > most:
        raise ValueError(f"{what}: {total} bytes, more than the {most} allowed on the driver")
    return df.collect()


def spread_sample(df: DataFrame, key: Column, size: Column, most: int) -> DataFrame:
    """About ``most`` units of ``size``, chosen by a hash of ``key``: the same rows at every run."""
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    if total <= most:
        return df
    steps = 1 << 20
    chosen = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(steps))
    return df.where(chosen < max(1, int(steps * most / total)))


def groups(starts: np.ndarray, total: int) -> np.ndarray:
    """The number of the group of each of ``total`` items, given where the groups start."""
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, total)))
