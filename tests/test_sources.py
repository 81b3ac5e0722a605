"""Schema files, and CSV lines that do not fit."""

from __future__ import annotations

import json

import pytest
from pyspark.sql.types import ArrayType, DateType, LongType, StringType, StructType

from helpers import rows
from shopmart.sources.bronze import SCHEMAS, load_csv, read_checked_csv
from shopmart.sources.schema_files import TYPES, parse_schema, read_schema

NAMES = {"string": "STRING", "bigint": "INT64", "double": "FLOAT64", "date": "DATE", "timestamp_ntz": "DATETIME"}


def as_json(table):
    fields = [f.strip().split(" ") for f in SCHEMAS[table].split(",")]
    return json.dumps([{"name": name, "type": NAMES[kind]} for name, kind in fields])


@pytest.mark.parametrize("table", sorted(SCHEMAS))
def test_files_give_the_declared_schemas(spark, tmp_path, table):
    path = tmp_path / f"{table}_schema.json"
    path.write_text(as_json(table))
    assert read_schema(spark, str(path)) == StructType.fromDDL(SCHEMAS[table])


def test_modes_records_and_comments():
    text = """[{"name": "a", "type": "string", "mode": "REQUIRED", "description": "what it is"},
      {"name": "b", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "c", "type": "DATE"}, {"name": "d", "type": "INTEGER"}]}]"""
    a, b = parse_schema(text)
    assert (a.dataType, a.nullable, a.metadata) == (StringType(), False, {"comment": "what it is"})
    assert isinstance(b.dataType, ArrayType) and [f.dataType for f in b.dataType.elementType] == [DateType(), LongType()]
    assert {t.typeName() for t in TYPES.values()} >= {"decimal", "timestamp", "boolean", "binary"}


@pytest.mark.parametrize("text", ['[{"name": "a", "type": "ODD"}]', '[{"name": "a", "type": "DATE", "mode": "X"}]', '[{"name": "a", "type": "DATE"}, {"name": "A", "type": "DATE"}]'])
def test_unknown_schemas_are_refused(text):
    with pytest.raises(ValueError):
        parse_schema(text)


def test_tables_are_loaded_by_schema_files(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("a,b,c,d\ns1,7,x,SP\n")
    (tmp_path / "sellers_schema.json").write_text(as_json("sellers"))
    folder = str(tmp_path)
    with pytest.raises(TypeError):  # a build needs all tables
        load_csv(spark, folder, ["sellers"], schemas=folder)
    table = spark.read.schema(read_schema(spark, f"{folder}/sellers_schema.json")).option("header", True).csv(f"{folder}/sellers.csv")
    assert rows(table) == [{"seller_id": "s1", "seller_zip_code_prefix": 7, "seller_city": "x", "seller_state": "SP"}]


def test_bad_lines_are_set_aside(spark, tmp_path):
    lines = ["id,n,day", "a,1,2018-01-02", "b,one,2018-01-02", "c,2", "d,3,2018-01-02,more", ",4,2018-01-02", "e,,2018-01-02", "f,5,not a day", '"g, h",6,']
    (tmp_path / "x.csv").write_text("\n".join(lines))
    checked = read_checked_csv(spark, "id string, n bigint, day date", str(tmp_path / "x.csv"), required=["id"])
    assert sorted(r["id"] for r in rows(checked.good)) == ["a", "e", "g, h"]
    rejected = {r["line"]: r["reason"] for r in rows(checked.rejected)}
    assert rejected == {
        "b,one,2018-01-02": "malformed",
        "c,2": "malformed",
        "d,3,2018-01-02,more": "malformed",
        "f,5,not a day": "malformed",
        ",4,2018-01-02": "missing",
    }
    assert all(r["file"].endswith("x.csv") for r in rows(checked.rejected))
    assert {(r["verdict"], r["reason"]): r["lines"] for r in rows(checked.counts())} == {
        ("good", None): 3, ("rejected", "malformed"): 4, ("rejected", "missing"): 1,
    }
    # Some columns alone see the same verdicts.
    assert checked.good.select("id").count() == 3


def test_an_empty_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,n\n")
    checked = read_checked_csv(spark, "id string, n bigint", str(tmp_path / "x.csv"))
    assert checked.good.count() == checked.rejected.count() == 0
