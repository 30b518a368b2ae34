"""Deliveries as files: names, formats, drift, empty and broken ones."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedgate import FeedContract
from feedgate.functions.columns import delivery_key, physical_format
from feedgate.operators.staging import normalize, union_deliveries
from feedgate.plans.workspace import Workspace
from feedgate.sources import deliveries as source
from feedgate.sources.inventory import inventory_files


def test_delivery_key(spark):
    paths = ["in/201912/claims_203111.csv", "claims_202604.parquet", "x/claims_2025.csv", "other", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    keys = [r.k for r in df.select(delivery_key(F.col("p")).alias("k")).collect()]
    assert keys[:4] == ["2031-11", "2026-04", "unknown", "unknown"]
    assert [source.Delivery(p).month for p in paths[:4]] == keys[:4]


def test_physical_format_ignores_case(spark):
    df = spark.createDataFrame([("A.CSV",), ("a.parquet",), (None,)], "p string")
    assert [r.f for r in df.select(physical_format(F.col("p")).alias("f")).collect()] == [
        "csv", "parquet", "parquet",
    ]
    assert source.Delivery("/x/CLAIMS_202509.CSV").file_format == "csv"


def test_delimited_fields_stay_text(spark, tmp_path):
    path = tmp_path / "claims_202509.csv"
    path.write_text('a|b|c\n007||"x""y"\n1.50|""| z \n')
    rows = [tuple(r) for r in source.read_delimited(spark, str(path)).collect()]
    assert rows == [("007", None, 'x"y'), ("1.50", None, " z ")]


def test_feed_unions_formats_and_drift(spark, tmp_path):
    folder = tmp_path.as_posix()
    spark.sql("SELECT 'A' AS claim_id, 123 AS npi, 'n' AS note").write.parquet(f"{folder}/claims_202501.parquet")
    spark.sql("SELECT 'B' AS claim_id, '0123' AS npi, DATE'2025-01-05' AS paid_date").write.parquet(
        f"{folder}/claims_202502.parquet"
    )
    (tmp_path / "claims_202503.csv").write_text("claim_id|npi|paid_date\nC|00123|2025-02-01\n")
    found = source.manifest(
        [f"{folder}/claims_202501.parquet", f"{folder}/claims_202502.parquet", f"{folder}/claims_202503.csv"]
    )
    df = source.read_feed(spark, found)
    rows = {r.claim_id: r for r in df.collect()}
    assert [rows[c].npi for c in "ABC"] == ["123", "0123", "00123"]
    assert [rows[c].paid_date for c in "ABC"] == [None, "2025-01-05", "2025-02-01"]
    assert [rows[c].note for c in "ABC"] == ["n", None, None]
    assert [rows[c]._delivery_month for c in "ABC"] == ["2025-01", "2025-02", "2025-03"]
    assert rows["C"]._source_file == "claims_202503.csv"


def test_filter_on_delivery_prunes_the_union(spark, tmp_path):
    folder = tmp_path.as_posix()
    paths = [f"{folder}/claims_20250{m}.parquet" for m in (1, 2, 3)]
    for p in paths:
        spark.range(3).selectExpr("cast(id AS string) AS claim_id").write.parquet(p)
    df = source.read_feed(spark, source.manifest(paths)).where("_delivery_month = '2025-02'")
    files = df.inputFiles()
    assert files and all("claims_202502" in f for f in files)


def test_inventory_lists_empty_and_broken_files(spark, tmp_path):
    folder = tmp_path.as_posix()
    spark.range(5).selectExpr("cast(id AS string) AS claim_id", "cast(id AS int) AS npi").write.parquet(
        f"{folder}/claims_202501.parquet"
    )
    (tmp_path / "claims_202502.csv").write_text("claim_id|npi\n")
    (tmp_path / "claims_202503.csv").write_text("")
    (tmp_path / "claims_202504.parquet").write_bytes(b"not parquet at all")
    names = ["claims_202501.parquet", "claims_202502.csv", "claims_202503.csv", "claims_202504.parquet"]
    found = source.manifest([f"{folder}/{n}" for n in names])
    df = inventory_files(spark, source.open_feed(spark, found))
    assert df.columns == [
        "s3_key", "delivery_month", "file_format", "row_count", "size_bytes", "columns_json",
    ]
    rows = {r.delivery_month: r for r in df.collect()}
    assert [rows[f"2025-0{m}"].row_count for m in (1, 2, 3, 4)] == [5, 0, None, None]
    assert rows["2025-02"].size_bytes == 13 and rows["2025-04"].size_bytes == 18
    assert rows["2025-01"].size_bytes > 0 and rows["2025-03"].size_bytes == 0
    assert json.loads(rows["2025-01"].columns_json)[:2] == [
        {"name": "claim_id", "type": "string"}, {"name": "npi", "type": "int"},
    ]
    assert rows["2025-03"].columns_json is None and rows["2025-04"].columns_json is None


def test_inventory_lists_absent_files(spark, tmp_path):
    (tmp_path / "claims_202501.csv").write_text("claim_id\nA\n")
    found = source.manifest([f"{tmp_path}/claims_202501.csv", f"{tmp_path}/claims_202502.csv"])
    rows = {r.delivery_month: r for r in inventory_files(spark, source.open_feed(spark, found)).collect()}
    assert (rows["2025-01"].row_count, rows["2025-01"].size_bytes) == (1, 11)
    assert (rows["2025-02"].row_count, rows["2025-02"].size_bytes) == (None, None)


def test_part_files_of_different_schemas_keep_all_columns(spark, tmp_path):
    folder = f"{tmp_path}/claims_202501.parquet"
    spark.sql("SELECT 'A' AS claim_id").write.parquet(folder)
    spark.sql("SELECT 'B' AS claim_id, '007' AS npi").write.mode("append").parquet(folder)
    df = source.read_feed(spark, source.manifest([folder]))
    assert {r.claim_id: r.npi for r in df.collect()} == {"A": None, "B": "007"}
    spark.sql("SELECT 'C' AS claim_id, 12 AS npi").write.mode("append").parquet(folder)
    df = source.read_feed(spark, source.manifest([folder]))
    assert {r.claim_id: r.npi for r in df.collect()} == {"A": None, "B": "007", "C": "12"}


def test_union_ignores_the_case_of_headers(spark, tmp_path):
    first = spark.sql("SELECT 'A' AS claim_id, 123 AS NPI")
    second = spark.sql("SELECT 'B' AS Claim_ID, '0x12' AS npi")
    df = union_deliveries([first, second])
    assert df.columns == ["claim_id", "NPI"]
    assert {r.claim_id: r.NPI for r in df.collect()} == {"A": "123", "B": "0x12"}
    contract = FeedContract()
    sent = [f"'1' AS {c}" if c != "npi" else "123 AS NPI" for c in contract.columns]
    lines = spark.range(1).selectExpr(*sent, "'2025-01' AS _delivery_month", "'claims_202501.parquet' AS _source_file")
    typed = normalize(lines, contract)
    assert dict(typed.dtypes)["npi"] == "string" and typed.first().npi == "123"


@pytest.mark.parametrize("row", ["1|2|3|EXTRA", "4|5"])
def test_ragged_rows_are_refused(spark, tmp_path, row):
    path = tmp_path / "claims_202501.csv"
    path.write_text(f"a|b|c\n1|2|3\n{row}\n")
    for chosen in (["a", "b", "c"], ["a"]):
        with pytest.raises((PySparkException, Py4JJavaError)):
            source.read_delimited(spark, str(path)).select(*chosen).collect()


def test_parts_with_another_header_order_are_refused(spark, tmp_path):
    folder = tmp_path / "claims_202501.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("a|b\n1|2\n")
    (folder / "2.csv").write_text("b|a\n2|1\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        source.read_delimited(spark, str(folder)).collect()


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "claims_202501.csv"
    path.write_text('a|b|c\n1|"x\ny"|3\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        source.read_delivery(spark, source.Delivery(str(path))).collect()
    rows = source.read_delivery(spark, source.Delivery(str(path), multiline=True)).select("a", "b", "c").collect()
    assert [tuple(r) for r in rows] == [("1", "x\ny", "3")]


def test_two_deliveries_of_a_month_are_refused():
    with pytest.raises(ValueError, match="2025-01"):
        source.manifest(["a/claims_202501.csv", "b/claims_202501.parquet"])


def test_closed_workspace_is_gone(spark, tmp_path):
    work = Workspace(spark, "probe", f"{tmp_path}/work")
    work.keep("numbers", spark.range(3))
    work.close()
    assert not (tmp_path / "work").exists()


def test_workspace_reads_the_shared_folder_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    work = Workspace(spark, "probe")
    if configured:
        assert work.root.startswith(configured.rstrip("/"))
    kept = work.keep("numbers", spark.range(3))
    assert kept.count() == 3 and kept.inputFiles()
