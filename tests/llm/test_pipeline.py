"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from feedgate.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    found = queries.queries()[name](spark, SF).toPandas()
    columns = sorted(found.columns)
    assert sorted(want.columns) == columns

    def rows(frame):
        return sorted(map(repr, frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()))

    assert rows(found) == rows(want)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns and after.exceptAll(docs).isEmpty(), name
        sizes.append((docs.count(), after.count()))
        docs = after
    assert all(0 < b <= a for a, b in sizes) and sizes[1][1] < sizes[1][0]
    out = corpus_pipeline.run(spark, SF)
    assert out.groupBy("shard", "slot").count().where("count > 1").isEmpty() and not out.isEmpty()


def test_contaminated_rows_are_dropped_row_by_row(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(1, "a clean text"), (1, f"before {item} after"), (None, f"{item} after"), (None, "another clean text"), (2, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=repr) == sorted((r for r in rows if not r[1] or "clean" in r[1]), key=repr)
