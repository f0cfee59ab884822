from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds a documents table from (doc_id, text[, lang[, source]]) rows."""

    def build(rows):
        full = [(r[0], r[1], *(r[2:] + (None, None))[:2], len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build
