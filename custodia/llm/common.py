"""Column handling shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def pick(df: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """Only the named columns, as ``new=(old, type)``.

    Columns are found by exact name and place, so that further columns, also such
    that differ by case only or bear a name used inside an operator, do no harm.
    """
    places = {name: k for k, name in reversed(list(enumerate(df.columns)))}
    flat = df.toDF(*[f"_{k}" for k in range(len(df.columns))])
    return flat.select(*[F.col(f"_{places[old]}").cast(kind).alias(new) for new, (old, kind) in columns.items()])


def annotate(
    df: DataFrame, column: str, compute: Callable[[Iterator[pa.RecordBatch], int], Iterator[tuple[pa.RecordBatch, list]]], added: T.StructType
) -> DataFrame:
    """All columns of ``df`` and the ``added`` ones, which replace columns of the same name.

    ``compute`` gets the batches and the place of ``column`` in them, and gives
    each (possibly smaller) batch with the arrays of the added columns.
    """
    flat = df.toDF(*[f"_{k}" for k in range(len(df.columns))])
    place = df.columns.index(column)
    flat = flat.withColumn(f"_{place}", F.col(f"_{place}").cast("string"))
    names = [*flat.columns, *[f"+{name}" for name in added.names]]
    schema = T.StructType([*flat.schema.fields, *[T.StructField(f"+{f.name}", f.dataType) for f in added.fields]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, arrays in compute(batches, place):
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names)

    out = flat.mapInArrow(run, schema)
    kept = [F.col(f"_{k}").alias(name) for k, name in enumerate(df.columns) if name not in added.names]
    return out.select(*kept, *[F.col(f"`+{name}`").alias(name) for name in added.names])


def binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column from the values behind one another and the n + 1 byte offsets."""
    wide = at[-1] >= 2**31
    kind, places = (pa.large_binary(), np.int64) if wide else (pa.binary(), np.int32)
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(places)), pa.py_buffer(np.ascontiguousarray(data))])
