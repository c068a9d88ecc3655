"""What the operators of this subpackage share: shared scratch tables, Arrow
row slices and 64-bit mixing."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpusflow.session import checkpoint_dir

#: rows that a Python task turns into Python objects at a time
SLICE = 256


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches, n: int = SLICE):
    """Arrow batches in pieces of ``n`` rows, so few Python objects live at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, n):
            yield batch.slice(at, n)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(batch: pa.RecordBatch, name: str) -> list:
    """A string column as UTF-8 ``bytes`` (None stays None)."""
    col = column(batch, name)
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Murmur3 finaliser on uint64 (wraps)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
