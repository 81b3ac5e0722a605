"""Small helpers of the document operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

# One task gets record batches of documents and yields batches of results.
Batches = Iterator[pa.RecordBatch]
# Workers on machines that have the package elsewhere get it by --py-files.
ROOT = str(Path(__file__).resolve().parents[2])


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator reads; other columns, whatever their names, stay out."""
    return docs.selectExpr("doc_id", "text", *more)


def carried(docs: DataFrame) -> DataFrame:
    """All columns of `docs` as one struct `row`, so that no name of an operator meets one of theirs."""
    return docs.select(F.struct("*").alias("row"))


def texts_in(part: pa.RecordBatch) -> list[str | None]:
    """The texts of a batch, in a column of their own or carried."""
    names = part.schema.names
    return (part.column("text") if "text" in names else part.column("row").field("text")).to_pylist()


def importable(spark: SparkSession) -> None:
    """Lets the Python workers of functions made from now on import this package."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, ROOT]))


def map_rows(df: DataFrame, work: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """Runs `work` once per task on its record batches."""
    importable(df.sparkSession)
    return df.mapInArrow(work, schema)


def with_long(df: DataFrame, column: str) -> StructType:
    """The schema of `df` with one more long at the end."""
    return StructType([*df.schema.fields, StructField(column, LongType())])


def batch(names: list[str], columns: list, types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def slices(rows: pa.RecordBatch, size: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that lists of Python texts stay short."""
    for at in range(0, rows.num_rows, size):
        yield rows.slice(at, size)
