"""Arrow IPC streams in memory as DataFrames, and DataFrames as such streams."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def from_ipc(spark: SparkSession, buffers: Iterable[bytes], view: str | None = None, force: bool = True) -> DataFrame:
    """The rows of IPC streams of one schema, in order; also as the temporary view ``view``.

    The view is this session's alone, and shadows a table of its name until ``forget``. Without ``force`` it replaces no other view.
    """
    tables = [pa.ipc.open_stream(b).read_all() for b in buffers]
    if not tables:
        raise ValueError("needs at least one stream, for the schema")
    df = spark.createDataFrame(pa.concat_tables(tables))
    if view and force:
        df.createOrReplaceTempView(view)
    elif view:
        df.createTempView(view)
    return df


def forget(spark: SparkSession, view: str) -> bool:
    """Drop the session's view; whether there was one."""
    return spark.catalog.dropTempView(view)


def to_ipc(df: DataFrame, max_rows: int = 65_536, codec: str | None = "zstd") -> bytes:
    """An IPC stream of a result that the driver can hold."""
    table = df.toArrow()
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as writer:
        writer.write_table(table, max_rows)
    return out.getvalue().to_pybytes()
