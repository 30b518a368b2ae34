"""The whole build over the derived deliveries, and the same rules restated in plain Python."""

from __future__ import annotations

import json
import random

import pytest
from checks import fixture
from conftest import CLEAN, GRAPH, collected, explained
from pyspark.sql import functions as F

from feedgate import FeedContract, job
from feedgate.operators import reconcile, versions
from feedgate.plans.build import (
    AUDIT_TABLES,
    SILVER_TABLES,
    BuildCheckError,
    build,
    check,
    current_build,
    register,
    reload_test,
)
from feedgate.plans.workspace import Workspace

SF_DIR = "/root/testdata/sf0.001"

# Totals of the derived deliveries at this scale.
RAW_LINES = 6_105
TOTALS = (5_495, 5_431, "280998607.27", 105)
HEADERS = 2_341
DECISIONS = {
    "2025-01": ("LOAD", ""),
    "2025-02": ("LOAD_WITH_WARNINGS", "COMPLETENESS_FAIL"),
    "2025-03": ("BLOCK", "SAME_MONTH_CONFLICT"),
    "2025-04": ("LOAD", ""),
    "2025-05": ("LOAD_WITH_WARNINGS", "COMPLETENESS_FAIL"),
    "2025-06": ("LOAD_WITH_WARNINGS", "COMPLETENESS_FAIL|TOKEN_VERSION_FAIL|TOKEN_RESOLUTION_LOW"),
    "2025-07": ("LOAD_WITH_WARNINGS", "COMPLETENESS_FAIL"),
    "2025-08": ("LOAD_WITH_WARNINGS", "DOMAIN_FAIL"),
    "2025-09": ("LOAD_WITH_WARNINGS", "WRONG_FORMAT|DOMAIN_FAIL"),
    "2025-10": ("LOAD_WITH_WARNINGS", "DOMAIN_FAIL"),
    "2025-11": (
        "LOAD_WITH_WARNINGS", "COMPLETENESS_FAIL|TOKEN_VERSION_FAIL|TOKEN_RESOLUTION_LOW|VOLUME_BAND_FAIL",
    ),
    "2025-12": ("BLOCK", "EMPTY_DELIVERY"),
}


@pytest.fixture(scope="module")
def deliveries(spark):
    return fixture.write_deliveries(spark, SF_DIR, Workspace(spark, "deliveries").path("in"))


@pytest.fixture(scope="module")
def built(spark, deliveries):
    found, graph = deliveries
    out = Workspace(spark, "out").path("tables")
    return build(spark, found, graph, out, fixture.contract(spark, SF_DIR))


def test_totals(built):
    row = built.totals().first()
    assert (row.silver_lines, row.current_lines, str(row.total_charge), row.quarantine_lines) == TOTALS
    assert built.tables["silver_claim_header"].count() == HEADERS


def test_decisions(built):
    rows = built.tables["promotion_decisions"].collect()
    assert {r._delivery_month: (r.decision, r.reason_codes) for r in rows} == DECISIONS


def test_every_accepted_row_is_accounted_for(built):
    rows = built.tables["reconciliation"].collect()
    assert sum(r.raw_rows for r in rows) == RAW_LINES
    for r in rows:
        explained = r.silver_eligible_rows + r.quarantine_rows + r.deduplicated_rows
        assert explained == (0 if r.decision == "BLOCK" else r.raw_rows)


def test_published_layout(spark, built):
    contract = FeedContract()
    path = f"{built.out}/silver_claim_line"
    table = spark.read.parquet(path)
    assert sorted(table.columns) == sorted(contract.published_columns)
    assert dict(table.dtypes)["charge_amount"] == "decimal(12,2)"
    assert dict(table.dtypes)["_delivery_month"] == "string"
    assert set(built.tables) == {*SILVER_TABLES, *AUDIT_TABLES}
    pruned = table.where("_delivery_month = '2025-04'").select(F.input_file_name().alias("f")).distinct()
    assert all("_delivery_month=2025-04" in r.f for r in pruned.collect())
    assert "PartitionFilters: [isnotnull(_delivery_month" in explained(table.where("_delivery_month = '2025-04'"))
    assert table.select("_ingested_at").distinct().count() == 1


def test_catalog(spark, built, deliveries):
    found, graph = deliveries
    folder = Workspace(spark, "database").path("db")
    spark.sql(f"CREATE DATABASE feedgate_test LOCATION '{folder}'")
    names = register(spark, built, "feedgate_test", found, graph)
    assert len(names) == len(SILVER_TABLES) + len(AUDIT_TABLES) + 13
    assert spark.table("feedgate_test.silver_claim_line").count() == TOTALS[0]
    raw = sum(spark.table(n).count() for n in names if "raw_claims" in n)
    assert raw == RAW_LINES
    assert dict(spark.table("feedgate_test.raw_claims_2025_04").dtypes)["npi"] == "int"
    assert dict(spark.table("feedgate_test.raw_claims_2025_09").dtypes)["npi"] == "string"
    report = spark.sql("""
        SELECT p.*, v.dx_populated FROM feedgate_test.promotion_decisions p
        LEFT JOIN feedgate_test.validation_results v USING (_delivery_month) ORDER BY _delivery_month""")
    assert report.count() == 12
    plan = spark.table("feedgate_test.silver_claim_line").where("_delivery_month = '2025-04'")
    assert "PartitionFilters: [isnotnull(_delivery_month" in explained(plan)


def test_reload(spark, deliveries):
    found, graph = deliveries
    out = Workspace(spark, "reload").path("tables")
    first, second = reload_test(spark, found, graph, out, fixture.contract(spark, SF_DIR))
    assert first == second and first.silver_lines == TOTALS[0]


def test_job(deliveries, spark, capsys):
    found, graph = deliveries
    out = Workspace(spark, "job").path("tables")
    paths = [d.path for d in found]
    job.main(["inventory", "--deliveries", *paths])
    listed = json.loads(capsys.readouterr().out)
    assert [r["row_count"] for r in listed][-1] == 0 and sum(r["row_count"] for r in listed) == RAW_LINES
    job.main(["run", "--deliveries", *paths, "--tokens", graph, "--out", out, "--sample-factor", "8000"])
    report = json.loads(capsys.readouterr().out)
    assert (report["silver_lines"], report["quarantine_lines"]) == (TOTALS[0], TOTALS[3])
    assert {r["_delivery_month"]: (r["decision"], r["reason_codes"]) for r in report["promotion_decisions"]} == DECISIONS


def test_unreadable_delivery_stops_the_build(spark, deliveries, tmp_path):
    found, graph = deliveries
    (tmp_path / "claims_202504.parquet").write_bytes(b"broken")
    broken = type(found[0])(str(tmp_path / "claims_202504.parquet"))
    out = Workspace(spark, "broken").path("tables")
    with pytest.raises(BuildCheckError, match="claims_202504"):
        build(spark, [found[0], broken], graph, out)
    listed = spark.read.parquet(f"{out}/inventory")
    assert listed.where("row_count IS NULL").count() == 1


def test_checks_raise(feed):
    plan = feed({}, {"claim_id": "B"})
    plan.__dict__["silver"] = plan.silver.unionByName(plan.silver)
    with pytest.raises(BuildCheckError, match="several rows for one line"):
        check(plan)
    plan = feed({}, {"claim_id": "B"})
    plan.__dict__["silver"] = plan.silver.where("claim_id = 'A'")
    with pytest.raises(BuildCheckError, match="accounted"):
        check(plan)


def brute_force(rows, contract):
    """Silver, quarantine and dropped counts of a small feed, one row at a time."""
    ids = {}
    for token, person in GRAPH:
        ids.setdefault(token, set()).update({person} - {None})
    names = list(CLEAN)
    lines = []
    for r in rows:
        month = r.get("month", "2025-01")
        line = {**CLEAN, **{k: v for k, v in r.items() if k != "month"}}
        content = tuple(line[n] or "" for n in names)
        lines.append((month, (line["claim_id"], line["claim_line"]), content, line))
    seen = {}
    for month, key, content, _ in lines:
        seen.setdefault((month, key), set()).add(content)
    blocked = {m for (m, _), contents in seen.items() if len(contents) > 1}
    if "SAME_MONTH_CONFLICT" not in contract.blocking_reasons:
        blocked = set()
    held, kept = [], []
    for month, key, content, line in lines:
        if month in blocked:
            continue
        clash = None not in key and len(seen[month, key]) > 1
        ambiguous = len(ids.get(line["member_token"], ())) > 1
        (held if clash or ambiguous else kept).append((month, key, content, line))
    first = {}
    for month, key, content, line in sorted(kept, key=lambda x: x[0]):
        first.setdefault((key, content), (month, key, content, line))
    last = {}
    for month, key, content, line in first.values():
        last.setdefault(key, []).append((month, content, line))
    return held, kept, last


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("blocking", [True, False])
def test_against_brute_force(spark, feed, seed, blocking):
    rng = random.Random(seed)
    rows = [
        {
            "claim_id": rng.choice(["A", "B", "C", None]),
            "claim_line": rng.choice(["1", "2", None]),
            "claim_freq_code": rng.choice(["1", "1", "7", "8"]),
            "original_claim_id": rng.choice(["A", "B", "C", None]),
            "member_token": rng.choice(["T1", "T2", "TX", "TN", "", None, "??"]),
            "units": rng.choice(["1", "2"]),
            "month": rng.choice(["2025-01", "2025-02", "2025-03", "2025-04"]),
        }
        for _ in range(30 if blocking else 60)
    ]
    if blocking:
        contents = {}
        rows = [
            r for r in rows
            if contents.setdefault((r["month"], r["claim_id"], r["claim_line"]), r) == r or rng.random() < 0.05
        ]
    extra = {} if blocking else {"blocking_reasons": ("EMPTY_DELIVERY",)}
    plan = feed(*rows, **extra)
    held, kept, last = brute_force(rows, plan.contract)
    hashes = {}
    for r in plan.normalized.collect():
        text = tuple("" if r[c] is None else str(r[c]) for c in CLEAN)
        hashes[text] = r._row_hash
    winners = {}
    for key, found in last.items():
        winners[key] = max(found, key=lambda x: (x[0], hashes[x[1]]))
    replaced = {w[2]["original_claim_id"] for w in winners.values() if w[2]["claim_freq_code"] == "7"} - {None}
    expected = sorted(
        ((key[0], key[1] and int(key[1]), w[0], hashes[w[1]], key[0] not in replaced) for key, w in winners.items()),
        key=repr,
    )
    silver = collected(plan.silver, "claim_id", "claim_line", "_delivery_month", "_row_hash", "is_current")
    assert silver == expected
    assert plan.quarantine.count() == len(held)
    assert plan.exceptions.where("_exception = 'dropped'").count() == len(kept) - len(winners)
    assert reconcile.reconciliation_failures(plan.reconciliation).isEmpty()
    ranks = collected(versions.version_rank(plan.earliest, plan.contract), "version_rank")
    assert ranks == sorted(((i + 1,) for found in last.values() for i in range(len(found))), key=repr)
    dup = versions.dedup_rank(plan.eligible, plan.contract)
    assert dup.count() == len(kept) and dup.where("dup_rank = 1").count() == sum(map(len, last.values()))


def test_order_and_partitioning_of_the_input_do_not_matter(spark, feed):
    rng = random.Random(7)
    rows = [
        {"claim_id": f"C{rng.randrange(12)}", "units": str(rng.randrange(1, 4)), "month": f"2025-0{rng.randrange(1, 6)}"}
        for _ in range(40)
    ]
    columns = ["claim_id", "units", "_delivery_month", "_row_hash", "is_current"]
    results = []
    for order in range(2):
        plan = feed(*rows, blocking_reasons=())
        results.append((collected(plan.silver, *columns), collected(plan.reconciliation, "*")))
        rng.shuffle(rows)
    assert results[0] == results[1]


def test_broadcast_and_shuffled_exceptions_agree(spark, feed):
    rows = [{"claim_id": f"C{i % 7}", "units": str(i % 3), "month": f"2025-0{1 + i % 4}"} for i in range(40)]
    plan = feed(*rows, blocking_reasons=())
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    plans = [collected(plan.silver_lines.drop("_ingested_at"), "*")]
    spark.conf.set(limit, "-1")
    try:
        plans.append(collected(plan.silver_lines.drop("_ingested_at"), "*"))
    finally:
        spark.conf.set(limit, before)
    assert plans[0] == plans[1] and plans[0]


def test_a_failed_check_leaves_the_previous_build(spark, deliveries, monkeypatch, tmp_path):
    found, graph = deliveries
    out = str(tmp_path / "out")
    contract = fixture.contract(spark, SF_DIR)
    build(spark, found, graph, out, contract)
    files = sorted(p.relative_to(out).as_posix() for p in (tmp_path / "out").rglob("*"))

    def fail(plan):
        raise BuildCheckError("forced")

    monkeypatch.setattr("feedgate.plans.build.check", fail)
    with pytest.raises(BuildCheckError, match="forced"):
        build(spark, found[:2], graph, out, contract)
    assert sorted(p.relative_to(out).as_posix() for p in (tmp_path / "out").rglob("*")) == files
    assert spark.read.parquet(f"{out}/silver_claim_line").count() == TOTALS[0]


def test_job_takes_contract_and_calendar(deliveries, spark, capsys, tmp_path):
    found, graph = deliveries
    settings = tmp_path / "contract.json"
    settings.write_text(json.dumps({"sample_factor": 8000, "blocking_reasons": ["EMPTY_DELIVERY", "WRONG_FORMAT"]}))
    job.main([
        "run", "--deliveries", found[0].path, found[8].path, "--tokens", graph, "--out", str(tmp_path / "out"),
        "--contract", str(settings), "--expected", "2025-01", "2025-07", "2025-09",
    ])
    report = json.loads(capsys.readouterr().out)
    decided = {r["_delivery_month"]: (r["decision"], r["reason_codes"].split("|")) for r in report["promotion_decisions"]}
    assert decided["2025-01"][0] != "BLOCK"
    assert decided["2025-07"] == ("BLOCK", ["EMPTY_DELIVERY"])
    assert decided["2025-09"][0] == "BLOCK" and "WRONG_FORMAT" in decided["2025-09"][1]


def test_all_tables_are_switched_at_once(spark, deliveries, monkeypatch, tmp_path):
    found, graph = deliveries
    out = str(tmp_path / "out")
    contract = fixture.contract(spark, SF_DIR)
    with pytest.raises(FileNotFoundError):
        current_build(spark, out)
    first = build(spark, found[:1], graph, out, contract, generations=2)
    before = {name: table.count() for name, table in first.tables.items()}
    assert set(before) == {*SILVER_TABLES, *AUDIT_TABLES}

    def fail(*_):
        raise OSError("forced")

    with monkeypatch.context() as patched:
        patched.setattr("feedgate.sinks.tables.point_to", fail)
        with pytest.raises(OSError, match="forced"):
            build(spark, found[:2], graph, out, contract, generations=2)
    current = current_build(spark, out)
    assert current.out == first.out and {n: t.count() for n, t in current.tables.items()} == before

    second = build(spark, found[:2], graph, out, contract, generations=2)
    current = current_build(spark, out)
    assert current.out == second.out != first.out
    assert {r.delivery_month for r in current.tables["inventory"].collect()} == {"2025-01", "2025-02"}
    assert current.totals().first() == second.totals().first()
    assert len(list((tmp_path / "out").glob("generation-*"))) == 2
    assert not list((tmp_path / "out").glob("_staging*"))
