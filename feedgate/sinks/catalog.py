"""Register written tables and raw deliveries in the session catalog."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedgate.functions.casts import as_text_sql
from feedgate.operators.staging import alignment
from feedgate.sinks.tables import PARTITION
from feedgate.sources.deliveries import Delivery, delimited_options, merged_schema, read_physical, schema_groups


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    df: DataFrame,
    partition: str | None = PARTITION,
    comment: str = "",
) -> None:
    """Drop and create an external table over ``path`` with the schema of ``df``.

    A partitioned table then discovers its partitions.
    """
    fields = [f for f in df.schema.fields if f.name != partition]
    if partition:
        fields += [f for f in df.schema.fields if f.name == partition]
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    partitioned = f"PARTITIONED BY ({_quoted(partition)})" if partition else ""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.sql(
        f"CREATE TABLE {_quoted(name)} ({columns}) USING parquet {partitioned} "
        f"LOCATION {_literal(path)} COMMENT {_literal(comment)}"
    )
    if partition:
        spark.sql(f"MSCK REPAIR TABLE {_quoted(name)}")


def register_audit(spark: SparkSession, name: str, path: str, df: DataFrame) -> None:
    register_table(spark, name, path, df, partition=None)


def raw_table_name(delivery: Delivery) -> str:
    return "raw_claims_" + delivery.month.replace("-", "_")


def _drop(spark: SparkSession, name: str) -> None:
    """Remove whatever has the name, be it a table or a view."""
    if spark.catalog.tableExists(name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {_quoted(name)}")


def _file_pattern(files: Sequence[str]) -> str:
    """A glob that matches the names of these files alone."""
    names = [re.sub(r"([\\{}\[\]*?,])", r"\\\1", f.rsplit("/", 1)[-1]) for f in files]
    return names[0] if len(names) == 1 else "{" + ",".join(names) + "}"


def _register_parts(spark: SparkSession, name: str, path: str) -> None:
    """Parts whose types differ: one table for each schema, and a view that puts them together as the reader does."""
    groups = schema_groups(spark, path)
    spelling, mixed = alignment([schema for schema, _ in groups])
    selects = []
    for number, (schema, files) in enumerate(groups, 1):
        part = f"{name}_part_{number}"
        _drop(spark, part)
        options = {"pathGlobFilter": _file_pattern(files), "recursiveFileLookup": "true"}
        spark.catalog.createTable(part, path=path, source="parquet", schema=schema, **options)
        sent = {f.name.lower(): f for f in schema.fields}

        def selected(lower: str, sent: dict[str, T.StructField] = sent) -> str:
            if lower not in sent:
                return f"NULL AS {_column(spelling[lower])}"
            value = _column(sent[lower].name)
            return f"{as_text_sql(value, sent[lower].dataType) if lower in mixed else value} AS {_column(spelling[lower])}"

        selects.append(f"SELECT {', '.join(selected(c) for c in spelling)} FROM {_quoted(part)}")
    spark.sql(f"CREATE VIEW {_quoted(name)} AS {' UNION ALL '.join(selects)}")


def register_raw(
    spark: SparkSession, database: str, deliveries: Sequence[Delivery], token_graph: str
) -> list[str]:
    """Every raw delivery with its own physical schema, and the token graph.

    Rows and columns are those of the readers: delimited deliveries are read with the same options, and refuse what
    the reader refuses; Parquet parts whose types differ become a view over one table for each schema.
    """
    names = []
    for d in deliveries:
        name = f"{database}.{raw_table_name(d)}"
        _drop(spark, name)
        if d.is_delimited:
            schema, options = read_physical(spark, d).schema, delimited_options(multiline=d.multiline)
            spark.catalog.createTable(name, path=d.path, source="csv", schema=schema, **options)
        elif (schema := merged_schema(spark, d.path)) is not None:
            spark.catalog.createTable(name, path=d.path, source="parquet", schema=schema)
        else:
            _register_parts(spark, name, d.path)
        names.append(name)
    graph = f"{database}.raw_member_tokens"
    _drop(spark, graph)
    spark.catalog.createTable(
        graph, path=token_graph, source="parquet", schema=spark.read.parquet(token_graph).schema
    )
    return [*names, graph]
