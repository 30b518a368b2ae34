"""Broken deliveries stop themselves alone, and the catalog reads what the readers read."""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from checks import fixture
from conftest import CLEAN, GRAPH, collected
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedgate import FeedContract, job
from feedgate.plans.build import build, register
from feedgate.plans.workspace import Workspace
from feedgate.sinks import catalog
from feedgate.sources import arrivals
from feedgate.sources import deliveries as source

BROKEN = (PySparkException, Py4JJavaError)


@pytest.fixture
def database(spark, tmp_path):
    name = "feedgate_" + "".join(c for c in tmp_path.name.lower() if c.isalnum())
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/database'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def tokens(spark, tmp_path):
    path = f"{tmp_path}/tokens.parquet"
    spark.createDataFrame(GRAPH, "member_token string, vi_pid string").write.parquet(path)
    return path


def rows_of(df):
    return df.columns, sorted(map(tuple, df.collect()), key=repr)


def both(spark, database, delivery, tokens):
    """A delivery through the catalog and through the reader: columns and rows, or the refusal."""
    name = catalog.register_raw(spark, database, [delivery], tokens)[0]
    found = []
    for read in (lambda: spark.table(name), lambda: source.read_physical(spark, delivery)):
        try:
            found.append(rows_of(read()))
        except BROKEN:
            found.append("refused")
    return found


@pytest.mark.parametrize(
    ("files", "multiline", "rows"),
    [
        ({"1": 'a|b|c\n1|"x\ny"|3\n'}, True, [("1", "x\ny", "3")]),
        ({"1": "a|b\n1|2\n", "2": "b|a\n2|1\n"}, False, "refused"),
        ({"1": "a|b|c\n1|2|3|EXTRA\n"}, False, "refused"),
        ({"1": "a|b|c\n4|5\n"}, False, "refused"),
        ({"1": 'a|b|c\n007||"x""y"\n', "2": "a|b|c\n| z |1.50\n"}, False, [("007", None, 'x"y'), (None, " z ", "1.50")]),
    ],
)
def test_raw_text_tables_read_as_the_reader(spark, tmp_path, database, tokens, files, multiline, rows):
    folder = tmp_path / "claims_202501.csv"
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    table, reader = both(spark, database, source.Delivery(str(folder), multiline), tokens)
    assert table == reader
    assert table == "refused" if rows == "refused" else table[1] == sorted(rows, key=repr)


def write_parts(folder, parts):
    folder.mkdir()
    for i, columns in enumerate(parts):
        pq.write_table(pa.table(columns), folder / f"part-{i:05d}.parquet")


def test_raw_parquet_tables_read_as_the_reader(spark, tmp_path, database, tokens):
    """Types that cannot be merged, other columns, other case, whole and broken numbers; then the same month again, mended."""
    folder = tmp_path / "claims_202501.parquet"
    write_parts(
        folder,
        [
            {"claim_id": ["A"], "NPI": pa.array([12], pa.int32()), "amount": [2.0]},
            {"claim_id": ["B"], "npi": ["007"], "amount": ["x"]},
            {"Claim_Id": ["C"], "amount": [2.5], "note": ["n"]},
            {"claim_id": [None], "NPI": pa.array([None], pa.int32()), "amount": [1e20]},
        ],
    )
    delivery = source.Delivery(str(folder))
    table, reader = both(spark, database, delivery, tokens)
    assert table == reader and table[0] == ["claim_id", "NPI", "amount", "note"]
    assert ("A", "12", "2.0", None) in table[1] and ("B", "007", "x", None) in table[1] and ("C", None, "2.5", "n") in table[1]
    again = tmp_path / "again" / "claims_202501.parquet"
    again.parent.mkdir()
    write_parts(again, [{"claim_id": ["A"]}, {"claim_id": ["B"], "npi": ["1"]}])
    table, reader = both(spark, database, source.Delivery(str(again)), tokens)
    assert table == reader and len(table[1]) == 2


def test_footers_of_many_parts_take_few_jobs(spark, tmp_path):
    """1,200 parts in three schemas: the jobs do not grow with the parts."""
    folder = tmp_path / "claims_202501.parquet"
    kinds = [{"claim_id": ["A"], "npi": pa.array([12], pa.int32())}, {"claim_id": ["B"], "npi": ["007"]}, {"claim_id": ["C"]}]
    write_parts(folder, [kinds[i % 3] for i in range(1200)])
    spark.sparkContext.setJobGroup("footers", "footers of many parts")
    try:
        df = source.read_parquet_delivery(spark, str(folder))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("footers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 12
    assert {(r.claim_id, r.npi): r["count"] for r in df.groupBy("claim_id", "npi").count().collect()} == {
        ("A", "12"): 400, ("B", "007"): 400, ("C", None): 400,
    }


def line(**changed):
    return {**CLEAN, **changed}


def write_text(path, rows):
    names = list(CLEAN)
    path.write_text("\n".join(["|".join(names), *["|".join(r[n] or "" for n in names) if isinstance(r, dict) else r for r in rows]]) + "\n")


@pytest.fixture
def feed_files(spark, tmp_path, tokens):
    """Four whole deliveries and one of each broken kind."""
    found = []
    for m in range(1, 5):
        lines = [tuple(line(claim_id=f"C{m}{i}", delivery_month=f"2025-0{m}").values()) for i in range(5)]
        path = f"{tmp_path}/claims_20250{m}.parquet"
        spark.createDataFrame(lines, ", ".join(f"{c} string" for c in CLEAN)).write.parquet(path)
        found.append(path)
    write_text(tmp_path / "claims_202505.csv", [line(claim_id="R1"), line(claim_id="R2"), "only|three|fields", "|".join(["x"] * 24)])
    (tmp_path / "claims_202506.parquet").write_bytes(b"no footer")
    (tmp_path / "claims_202507.csv").write_text("claim_id|claim_line\nM1|1\n")
    (tmp_path / "claims_202508.csv").write_text("")
    folder = tmp_path / "claims_202509.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("claim_id|claim_line\nM1|1\n")
    (folder / "2.csv").write_text("claim_line|claim_id\n1|M2\n")
    found += [f"{tmp_path}/claims_20250{m}.{e}" for m, e in ((5, "csv"), (6, "parquet"), (7, "csv"), (8, "csv"), (9, "csv"))]
    found.append(f"{tmp_path}/claims_202510.parquet")
    return source.manifest(found)


CONTRACT = FeedContract(min_claim_lines=0, volume_band=1e9)
REASONS = {
    "2025-05": "REJECTED_ROWS|WRONG_FORMAT",
    "2025-06": "UNREADABLE_FILE",
    "2025-07": "MISSING_REQUIRED_COLUMNS",
    "2025-08": "UNREADABLE_FILE",
    "2025-09": "UNREADABLE_FILE",
    "2025-10": "UNREADABLE_FILE",
}


def test_broken_deliveries_block_themselves_alone(spark, tmp_path, feed_files, tokens):
    built = build(spark, feed_files, tokens, f"{tmp_path}/out", CONTRACT, isolate=True)
    decided = {r._delivery_month: (r.decision, r.reason_codes) for r in built.tables["promotion_decisions"].collect()}
    assert decided == {f"2025-0{m}": ("LOAD", "") for m in range(1, 5)} | {m: ("BLOCK", r) for m, r in REASONS.items()}
    assert collected(built.tables["silver_claim_line"], "claim_id") == sorted((f"C{m}{i}",) for m in range(1, 5) for i in range(5))
    rejected = built.tables["rejected_rows"].collect()
    assert sorted((r._delivery_month, r._source_file, r.record) for r in rejected) == [
        ("2025-05", "claims_202505.csv", "only|three|fields"), ("2025-05", "claims_202505.csv", "|".join(["x"] * 24)),
    ]
    assert all(r.file_path.endswith("/claims_202505.csv") for r in rejected)
    counts = {r.delivery_month: (r.row_count, r.columns_json is None) for r in built.tables["inventory"].collect()}
    assert counts["2025-05"] == (2, False) and counts["2025-06"] == (None, True) and counts["2025-07"] == (1, False)
    reconciled = {r._delivery_month: r.raw_rows for r in built.tables["reconciliation"].collect()}
    assert reconciled["2025-01"] == 5 and reconciled["2025-05"] == 2 and reconciled["2025-06"] == 0


def test_isolated_build_of_whole_deliveries_changes_nothing(spark, tmp_path):
    work = Workspace(spark, "isolated", f"{tmp_path}/work")
    found, graph = fixture.write_deliveries(spark, "/root/testdata/sf0.001", work.path("in"))
    contract = fixture.contract(spark, "/root/testdata/sf0.001")
    plain, apart = (build(spark, found, graph, work.path(name), contract, isolate=name == "apart") for name in ("plain", "apart"))
    for table in ("silver_claim_line", "silver_claim_header", "silver_claim_line_quarantine"):
        one, two = (b.tables[table].drop("_ingested_at") for b in (plain, apart))
        assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert collected(plain.tables["promotion_decisions"], "_delivery_month", "reason_codes") == collected(
        apart.tables["promotion_decisions"], "_delivery_month", "reason_codes"
    )
    assert apart.tables["rejected_rows"].isEmpty()


def test_a_feed_without_any_readable_delivery(spark, tmp_path, tokens):
    (tmp_path / "claims_202501.parquet").write_bytes(b"no footer")
    found = source.manifest([f"{tmp_path}/claims_202501.parquet", f"{tmp_path}/claims_202502.parquet"])
    built = build(spark, found, tokens, f"{tmp_path}/out", CONTRACT, isolate=True)
    assert collected(built.tables["promotion_decisions"], "reason_codes") == [("UNREADABLE_FILE",)] * 2
    assert built.tables["silver_claim_line"].isEmpty() and built.tables["inventory"].count() == 2


def test_required_columns_and_blocking_are_the_contracts(spark, tmp_path, feed_files):
    work = Workspace(spark, "arrivals", f"{tmp_path}/work")
    contract = FeedContract(required_columns=("CLAIM_ID",))
    found = arrivals.receive(spark, feed_files, contract, work.keep)
    reasons = {r._delivery_month: r.reason for r in found.issues.collect()}
    assert "2025-07" not in reasons and reasons["2025-05"] == "REJECTED_ROWS"
    staged = found.staged(contract)
    assert staged.where("_delivery_month = '2025-07'").count() == 1
    assert staged.where(F.col("_delivery_month") == "2025-05").count() == 2


def test_quoted_line_breaks_and_rejected_rows(spark, tmp_path):
    path = tmp_path / "claims_202501.csv"
    path.write_text('a|b\n1|"x\ny"\n2\n3|"p|q"\n')
    work = Workspace(spark, "arrivals", f"{tmp_path}/work")
    delivery = source.Delivery(str(path), multiline=True)
    found = arrivals.receive(spark, [delivery], FeedContract(required_columns=("a",)), work.keep)
    assert collected(found.frames[delivery], "a", "b") == [("1", "x\ny"), ("3", "p|q")]
    assert [r.record.strip() for r in found.rejected.collect()] == ["2"]


def test_job_isolates_and_registers(spark, tmp_path, feed_files, tokens, capsys, database):
    settings = tmp_path / "contract.json"
    settings.write_text(json.dumps({"min_claim_lines": 0, "volume_band": 1e9}))
    paths = [d.path for d in feed_files]
    job.main(["run", "--isolate", "--deliveries", *paths, "--tokens", tokens, "--out", f"{tmp_path}/out", "--contract", str(settings)])
    report = json.loads(capsys.readouterr().out)
    assert {r["_delivery_month"]: r["reason_codes"] for r in report["promotion_decisions"] if r["decision"] == "BLOCK"} == REASONS
    built = build(spark, feed_files, tokens, f"{tmp_path}/again", CONTRACT, isolate=True)
    names = register(spark, built, database)
    assert f"{database}.rejected_rows" in names and spark.table(f"{database}.rejected_rows").count() == 2
