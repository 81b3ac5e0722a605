"""Table schemas from JSON files: a list of fields with name, type, mode and nested fields."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Type names of schema files.
TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "BYTES": BinaryType(),
    "INT64": LongType(),
    "INTEGER": LongType(),
    "FLOAT64": DoubleType(),
    "FLOAT": DoubleType(),
    "NUMERIC": DecimalType(38, 9),
    "BOOL": BooleanType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "DATETIME": TimestampNTZType(),
    "TIMESTAMP": TimestampType(),
}
RECORDS = ("RECORD", "STRUCT")
MODES = ("NULLABLE", "REQUIRED", "REPEATED")


def _field(entry: dict) -> StructField:
    name, kind = entry["name"], str(entry["type"]).upper()
    mode = str(entry.get("mode") or "NULLABLE").upper()
    if mode not in MODES:
        raise ValueError(f"{name}: unknown mode {mode}")
    if kind in RECORDS:
        data_type: DataType = StructType([_field(f) for f in entry["fields"]])
    elif kind in TYPES:
        data_type = TYPES[kind]
    else:
        raise ValueError(f"{name}: unknown type {kind}")
    comment = {"comment": entry["description"]} if entry.get("description") else {}
    if mode == "REPEATED":
        return StructField(name, ArrayType(data_type, containsNull=False), True, comment)
    return StructField(name, data_type, mode != "REQUIRED", comment)


def parse_schema(text: str) -> StructType:
    """The schema a JSON text describes; a REQUIRED field is not nullable, a REPEATED one an array."""
    fields = [_field(entry) for entry in json.loads(text)]
    names = [f.name.lower() for f in fields]
    if len(set(names)) < len(names):
        raise ValueError(f"repeated field: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return StructType(fields)


def read_schema(spark: SparkSession, path: str) -> StructType:
    """The schema in a file that Spark can reach."""
    return parse_schema(spark.read.option("wholetext", True).text(path).first()[0])
