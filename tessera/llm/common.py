"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage, ensure_checkpoint_dir

#: Bytes of text that a Python task turns into numpy arrays at a time.  Only
#: memory depends on it, never a result; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df_or_names, base: str) -> str:
    """``base``, or base with a suffix that no column of the frame has (case-blind)."""
    names = df_or_names.columns if isinstance(df_or_names, DataFrame) else df_or_names
    taken = {c.lower() for c in names}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces allowed)."""
    return F.col(f"`{name.replace('`', '``')}`")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def via_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and gives the planner
    the real size, so that a join with a small table needs no shuffle of the large side."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int]]:
    """(offset, length) of consecutive row ranges of about SLICE_BYTES of text."""
    lengths = batch.column(column)
    sizes = pa.compute.binary_length(lengths).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > SLICE_BYTES:
            yield start, i - start
            start, total = i, 0
        total += n + 1
    if start < len(sizes):
        yield start, len(sizes) - start


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: T.StructType) -> DataFrame:
    """mapInArrow for frames whose column names may hold dots or back-quotes.

    ``fn`` sees the real names; it must yield columns in the order of ``schema``.
    """
    names = df.columns
    safe = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(b.rename_columns(names) for b in batches):
            yield out.rename_columns(safe.names)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, safe).toDF(*schema.names)


def with_fields(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(n, t) for n, t in fields])


__all__ = ["read_table", "fresh_name", "col", "scratch_path", "via_table", "text_slices",
           "with_fields", "map_arrow", "cut_lineage", "SLICE_BYTES"]
