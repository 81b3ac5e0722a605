from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, place string, fp string, size string"


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns whose names operators use inside."""

    def build(rows, parts=3):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "web", None, "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return build


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
