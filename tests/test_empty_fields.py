"""Validation queries against their SQL on records whose text, source or id is empty or null."""

import duckdb
import pytest

from millrace.plans.catalogue import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    texts, sources = ["a text", "", None, " "], ["web", None, ""]
    rows = [(i, texts[i % 4], "en", sources[i % 3]) for i in range(2000)] + [(None, "a text", "en", "web"), (None, "", "en", "web"), (-17, "", "en", "web"), (-901, None, "en", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(str(folder / "documents.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["validate_missing", "validate_errors", "validate_defaults", "validate_duplicate_id", "validate_empty"])
def test_empty_and_null_fields(spark, empty, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{empty}/documents.parquet/*.parquet')")
    wanted = sorted(map(repr, db.sql(ORACLE_SQL[name]).fetchall()))
    assert wanted and sorted(repr(tuple(r)) for r in QUERIES[name](spark, empty).collect()) == wanted
