"""How partitioned tables are written: mixed tasks stay small, published tables are compressed."""

from __future__ import annotations

import pytest
from conftest import collected
from pyspark.sql import functions as F

from checks import fixture
from feedgate.plans.workspace import Workspace
from feedgate.sinks import tables


def test_deliveries_are_derived_by_small_tasks(spark, monkeypatch, tmp_path):
    """Lines much wider than what was shuffled are written by tasks of a bounded size, and the session's setting comes back."""
    before = spark.conf.get(tables.ADVISORY)
    with pytest.raises(RuntimeError), tables.small_tasks(spark):
        raise RuntimeError
    assert spark.conf.get(tables.ADVISORY) == before
    written = []
    keep = tables._set
    monkeypatch.setattr(tables, "_set", lambda session, name, value: written.append((name, value)) or keep(session, name, value))
    fixture.write_deliveries(spark, "/root/testdata/sf0.001", str(tmp_path / "in"))
    assert (tables.ADVISORY, str(tables.SORTED_BYTES)) in written
    assert spark.conf.get(tables.ADVISORY) == before


def test_a_task_that_meets_several_deliveries_sorts_them(spark):
    """Whole tables come back however many deliveries a task holds."""
    lines = spark.range(100).select("id", (F.col("id") % 7).cast("string").alias("month")).coalesce(1)
    with tables.side_by_side(spark):
        assert int(spark.conf.get(tables.WRITERS)) == tables.OPEN_DELIVERIES == 1
    kept = Workspace(spark, "mixed").keep("lines", lines, partition="month")
    assert collected(kept, "id", "month") == collected(lines, "id", "month")


def test_published_tables_are_zstd(spark, tmp_path):
    lines = spark.range(100).select("id", F.concat(F.lit("2025-0"), (F.col("id") % 3 + 1).cast("string")).alias("_delivery_month"))
    tables.write_partitioned(lines, str(tmp_path / "out"))
    parts = [p.name for p in (tmp_path / "out").glob("_delivery_month=*/part-*")]
    assert parts and all(".zstd." in name for name in parts)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
