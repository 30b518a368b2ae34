from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from feedgate import FeedContract  # noqa: E402
from feedgate.plans.feed import FeedPlan  # noqa: E402
from feedgate.plans.workspace import Workspace  # noqa: E402

# A clean claim line; tests override what they are about.
CLEAN = {
    "claim_id": "A",
    "claim_line": "1",
    "claim_freq_code": "1",
    "original_claim_id": None,
    "member_token": "T1",
    "token_version": "v2",
    "patient_id": "P1",
    "member_zip": "01234",
    "gender": "F",
    "birth_year": "1980",
    "dx_code": "E11",
    "icd_version": "10",
    "procedure_code": "PR1",
    "place_of_service": "11",
    "npi": "1000000001",
    "date_of_service": "2025-01-05",
    "paid_date": "2025-01-10",
    "charge_amount": "100.00",
    "allowed_amount": "90.00",
    "units": "1",
    "claim_type": "PROF",
    "source_system": "S1",
    "delivery_month": "2025-01",
}
GRAPH = [("T1", "V1"), ("T2", "V2"), ("TX", "V8"), ("TX", "V9"), ("TN", None)]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("feedgate-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def staged(spark):
    """Build staged lines from overrides of a clean line; ``month`` is the delivery."""

    def make(*rows: dict):
        columns = [*CLEAN, "_delivery_month", "_source_file"]
        data = []
        for row in rows:
            month = row.get("month", "2025-01")
            line = {**CLEAN, **{k: v for k, v in row.items() if k != "month"}}
            file = f"claims_{month.replace('-', '')}.parquet"
            data.append(tuple(line.values()) + (month, file))
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))

    return make


@pytest.fixture
def graph(spark):
    return spark.createDataFrame(GRAPH, "member_token string, vi_pid string")


@pytest.fixture
def feed(spark, staged, graph):
    """A plan over a few lines, with thresholds that only let the gate see conflicts."""

    def make(*rows: dict, months=None, **contract):
        months = months or sorted({r.get("month", "2025-01") for r in rows})
        settings = {"min_claim_lines": 0, "volume_band": 1e9, **contract}
        return FeedPlan(
            staged(*rows),
            graph,
            spark.createDataFrame([(m,) for m in months], "delivery_month string"),
            FeedContract(**settings),
            Workspace(spark, "test").keep,
            F.lit("2025-12-31 00:00:00").cast("timestamp"),
        )

    return make


def collected(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def explained(df) -> str:
    """The formatted physical plan as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
