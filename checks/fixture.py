"""Claim deliveries derived from the driver tables.

The same SQL text is the Spark input and the CTE in front of every oracle; it uses only syntax both
engines share. Every lineitem row becomes a claim line. The modulo conditions seed defects (copies,
corrections, blanks, drift); they do not select a subset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedgate import FeedContract
from feedgate.sinks.tables import exists, publish, side_by_side, small_tasks
from feedgate.sources.deliveries import Delivery

MONTHS = [f"2025-{m:02d}" for m in range(1, 13)]

RAW_CLAIMS = """
WITH li AS (
  SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, l.l_partkey AS pk, l.l_suppkey AS sk,
         cast(l.l_quantity AS int) AS qty, cast(l.l_extendedprice AS decimal(12,2)) AS price,
         cast(l.l_shipdate AS date) AS ship, o.o_custkey AS ck,
         row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber
             ORDER BY l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_shipdate) AS rn
  FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
), base AS (
  SELECT CASE WHEN rn = 1 THEN 'C' || cast(ok AS string) ELSE 'X' || cast(ok AS string) || '-' || cast(rn AS string) END AS claim_id,
         ln AS claim_line, ok, pk, sk, qty, price, ship, ck, rn,
         CASE WHEN rn > 1 THEN 11 ELSE cast(ok % 11 AS int) + 1 END AS m, 0 AS kind
  FROM li
), versions AS (
  SELECT * FROM base
  UNION ALL SELECT claim_id, claim_line, ok, pk, sk, qty, price, ship, ck, rn, m + 1, 1 FROM base WHERE rn = 1 AND m < 11 AND ok % 97 = 0
  UNION ALL SELECT claim_id, claim_line, ok, pk, sk, qty, cast(price + 10 AS decimal(12,2)), ship, ck, rn, m + 1, 2 FROM base WHERE rn = 1 AND m < 11 AND ok % 89 = 1 AND ok % 97 <> 0
  UNION ALL SELECT claim_id, claim_line, ok, pk, sk, qty, cast(price + 5 AS decimal(12,2)), ship, ck, rn, m, 3 FROM base WHERE rn = 1 AND m = 3 AND ok % 50 = 2
)
SELECT claim_id, cast(claim_line AS string) AS claim_line,
  CASE WHEN rn = 1 AND ok % 61 = 0 AND ok >= 11 THEN '7' WHEN rn = 1 AND ok % 67 = 0 AND ok >= 11 THEN '8' ELSE '1' END AS claim_freq_code,
  CASE WHEN rn = 1 AND ok >= 11 AND (ok % 61 = 0 OR ok % 67 = 0) THEN 'C' || cast(ok - 11 AS string) END AS original_claim_id,
  CASE WHEN m = 6 AND ok % 40 = 5 THEN NULL WHEN m = 11 AND ok % 17 = 0 THEN '' WHEN m IN (6, 11) AND ck % 2 = 1 THEN 'U' || cast(ck AS string) ELSE 'T' || cast(ck AS string) END AS member_token,
  CASE WHEN m = 11 OR (m = 6 AND ck % 2 = 1) THEN 'v1' ELSE 'v2' END AS token_version,
  CASE WHEN ok % 500 = 7 THEN 'P' || cast(ck + 1 AS string) ELSE 'P' || cast(ck AS string) END AS patient_id,
  CASE WHEN m IN (4, 5) THEN cast(ck % 100000 AS string) ELSE lpad(cast(ck % 100000 AS string), 5, '0') END AS member_zip,
  CASE WHEN m IN (8, 9, 10) AND ck % 3 = 0 THEN 'Female' WHEN ck % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  cast(1940 + ck % 60 AS string) AS birth_year,
  CASE WHEN m = 7 AND pk % 5 = 0 THEN NULL WHEN m = 7 AND pk % 7 = 0 THEN ' ' ELSE 'E' || cast(pk % 90 + 10 AS string) END AS dx_code,
  '10' AS icd_version, 'PR' || cast(pk % 1000 AS string) AS procedure_code,
  CASE WHEN m IN (4, 5) THEN cast(sk % 30 AS string) ELSE lpad(cast(sk % 30 AS string), 2, '0') END AS place_of_service,
  CASE WHEN m = 2 AND sk % 20 = 0 THEN NULL ELSE cast(1000000000 + sk AS string) END AS npi,
  CASE WHEN m = 5 AND ok % 100 = 15 THEN '2025-02-30' ELSE cast(ship AS string) END AS date_of_service,
  CASE WHEN ok % 400 = 9 THEN cast(ship - claim_line AS string) WHEN ok % 300 = 8 THEN NULL ELSE cast(ship + claim_line AS string) END AS paid_date,
  CASE WHEN rn = 1 AND ok % 67 = 0 AND ok % 61 <> 0 AND ok >= 11 THEN '-' || cast(price AS string) WHEN ok % 900 = 10 THEN '-1.00' ELSE cast(price AS string) END AS charge_amount,
  cast(cast(price - 1 AS decimal(12,2)) AS string) AS allowed_amount,
  CASE WHEN ok % 700 = 4 THEN '0' ELSE cast(qty AS string) END AS units,
  CASE WHEN pk % 2 = 0 THEN 'PROF' ELSE 'INST' END AS claim_type, 'S' || cast(sk % 3 AS string) AS source_system,
  '2025-' || lpad(cast(CASE WHEN kind = 1 THEN m - 1 ELSE m END AS string), 2, '0') AS delivery_month,
  '2025-' || lpad(cast(m AS string), 2, '0') AS _delivery_month,
  'claims_2025' || lpad(cast(m AS string), 2, '0') || CASE WHEN m = 9 THEN '.csv' ELSE '.parquet' END AS _source_file
FROM versions
"""

MEMBER_TOKENS = """
SELECT 'T' || cast(c_custkey AS string) AS member_token, 'V' || cast(c_custkey AS string) AS vi_pid FROM {customer} WHERE c_custkey % 20 <> 19
UNION ALL
SELECT 'T' || cast(c_custkey AS string), 'V' || cast(c_custkey + 1000000 AS string) FROM {customer} WHERE c_custkey % 50 = 0
"""

# Deliveries arrive in part files of at most this many lines.
LINES_PER_FILE = 25_000

# Orders at scale factor 1 times the sample factor of 8 used there.
SCALED_ORDERS = 12_000_000


def _tables(sf_dir: str) -> dict[str, str]:
    names = ("lineitem", "orders", "customer")
    return {n: f"parquet.`{sf_dir.rstrip('/')}/{n}.parquet`" for n in names}


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_CLAIMS.format(**_tables(sf_dir)))


def member_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MEMBER_TOKENS.format(**_tables(sf_dir)))


def expected(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m,) for m in MONTHS], "delivery_month string")


def contract(spark: SparkSession, sf_dir: str) -> FeedContract:
    """The default agreement with the sample factor that belongs to the scale of the tables."""
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").count()
    return FeedContract(sample_factor=SCALED_ORDERS // orders)


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """From the footers."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").count()


def _physical(claims: DataFrame, month: str) -> DataFrame:
    """One delivery as the vendor sends it: months 4 and 5 carry three codes as integers."""
    delivery = claims.where(F.col("_delivery_month") == month).drop("_delivery_month")
    if month in ("2025-04", "2025-05"):
        return delivery.withColumns(
            {c: F.col(c).cast("int") for c in ("member_zip", "place_of_service", "npi")}
        )
    return delivery


def write_deliveries(spark: SparkSession, sf_dir: str, folder: str) -> tuple[list[Delivery], str]:
    """Write the derived deliveries in their physical formats; months 9 and 12 are delimited text.

    All are staged in one pass. A delivery sent as it is staged takes its folder; the others are written anew. Text
    is compressed, which costs no parallelism: its part files are small.
    """
    staged, graph = f"{folder}/staged", f"{folder}/member_tokens.parquet"
    lines = raw_claims(spark, sf_dir).drop("_source_file")
    with side_by_side(spark), small_tasks(spark):
        staging = lines.write.partitionBy("_delivery_month").option("maxRecordsPerFile", LINES_PER_FILE)
        staging.parquet(staged, compression="zstd")
    member_tokens(spark, sf_dir).write.parquet(graph)
    claims = spark.read.schema(lines.schema).parquet(staged)
    deliveries = []
    for month in MONTHS:
        delimited = month in ("2025-09", "2025-12")
        name = f"claims_{month.replace('-', '')}.{'csv' if delimited else 'parquet'}"
        delivery = Delivery(f"{folder}/{name}")
        sent = _physical(claims, month)
        writer = sent.write.option("maxRecordsPerFile", LINES_PER_FILE)
        as_staged = sent.schema == claims.drop("_delivery_month").schema
        if delimited:
            writer.csv(delivery.path, sep="|", header=True, escape='"', compression="gzip")
        elif as_staged and exists(spark, f"{staged}/_delivery_month={month}"):
            publish(spark, f"{staged}/_delivery_month={month}", delivery.path)
        else:
            writer.parquet(delivery.path, compression="zstd")
        deliveries.append(delivery)
    return deliveries, graph
