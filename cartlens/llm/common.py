"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of whole texts in one Arrow batch; texts of 100 kB then make batches of tens of MB.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that bound what one Arrow batch of whole texts can take."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names an operator uses; extra columns never get in its way."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def whole_text(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def field_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def strings(column: pa.Array) -> list[str]:
    """Python strings, a null as the empty string."""
    return [x or "" for x in column.to_pylist()]


def longs(values: Iterable[int] | np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))


@contextmanager
def no_cycle_search() -> Iterator[None]:
    """For loops that keep very many small values and make no reference cycles: Python's search for cycles
    would walk through all of them again and again."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()
