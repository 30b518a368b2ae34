"""Entry point for spark-submit: inventory, full build, or the reload test.

    spark-submit feedgate/job.py run --deliveries <path> ... --tokens <path> --out <path>

``--contract`` names a JSON file that sets fields of the contract; ``--expected`` lists the months that must arrive.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from feedgate.contract import FeedContract  # noqa: E402
from feedgate.plans.build import Build, build, register, reload_test  # noqa: E402
from feedgate.sources.deliveries import manifest, open_feed  # noqa: E402
from feedgate.sources.inventory import inventory_files  # noqa: E402


def summary(built: Build) -> dict:
    """Totals, decisions and reconciliation of a build; a row per delivery reaches the driver."""
    report = built.totals().first().asDict()
    for name in ("promotion_decisions", "reconciliation"):
        rows = built.tables[name].orderBy("_delivery_month").collect()
        report[name] = [r.asDict() for r in rows]
    return report


def _arguments(argv: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="feedgate", description=__doc__)
    parser.add_argument("command", choices=["inventory", "run", "reload-test"])
    parser.add_argument("--deliveries", nargs="+", required=True, help="files or folders named claims_YYYYMM.*")
    parser.add_argument("--tokens", help="token graph (Parquet)")
    parser.add_argument("--out", help="folder of the published tables")
    parser.add_argument("--database", help="catalog database to register the tables in")
    parser.add_argument("--contract", help="JSON file with fields of the contract: thresholds, domains, block codes")
    parser.add_argument("--sample-factor", type=int, help="overrides the contract")
    parser.add_argument("--expected", nargs="+", metavar="YYYY-MM", help="the calendar; by default what is delivered")
    parser.add_argument("--multiline", action="store_true", help="delimited deliveries hold quoted line breaks")
    parser.add_argument("--isolate", action="store_true", help="block broken deliveries one by one instead of stopping")
    parser.add_argument("--generations", type=int, default=0, help="switch all tables at once and keep so many builds")
    arguments = parser.parse_args(argv)
    if arguments.command != "inventory" and not (arguments.tokens and arguments.out):
        parser.error("--tokens and --out are needed to build")
    return arguments


def _contract(chosen: argparse.Namespace) -> FeedContract:
    fields = json.loads(Path(chosen.contract).read_text()) if chosen.contract else {}
    if chosen.sample_factor is not None:
        fields["sample_factor"] = chosen.sample_factor
    return FeedContract(**{name: tuple(v) if isinstance(v, list) else v for name, v in fields.items()})


def main(argv: Sequence[str]) -> None:
    chosen = _arguments(argv)
    spark = SparkSession.builder.appName(f"feedgate-{chosen.command}").getOrCreate()
    deliveries = manifest(chosen.deliveries, chosen.multiline)
    contract = _contract(chosen)
    expected = chosen.expected and spark.createDataFrame([(m,) for m in chosen.expected], "delivery_month string")
    if chosen.command == "inventory":
        rows = inventory_files(spark, open_feed(spark, deliveries)).orderBy("delivery_month").collect()
        print(json.dumps([r.asDict() for r in rows], indent=2))
    elif chosen.command == "reload-test":
        first, second = reload_test(spark, deliveries, chosen.tokens, chosen.out, contract, expected)
        print(json.dumps({"first": first.asDict(), "second": second.asDict()}, indent=2, default=str))
    else:
        built = build(spark, deliveries, chosen.tokens, chosen.out, contract, expected, isolate=chosen.isolate, generations=chosen.generations)
        if chosen.database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{chosen.database}`")
            register(spark, built, chosen.database, deliveries, chosen.tokens)
        print(json.dumps(summary(built), indent=2, default=str))


if __name__ == "__main__":
    main(sys.argv[1:])
