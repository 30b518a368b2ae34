"""Resolve member tokens to person ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.functions.columns import blank


def resolve_tokens(graph: DataFrame) -> DataFrame:
    """One row per token: its person id when there is exactly one, and whether there are several.

    Lowest and highest id answer both questions in one aggregation without counting distinct ids.
    """
    span = graph.groupBy("member_token").agg(
        F.min("vi_pid").alias("_low"), F.max("vi_pid").alias("_high")
    )
    return span.select(
        "member_token",
        F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias("vi_pid"),
        F.coalesce(F.col("_low") < F.col("_high"), F.lit(False)).alias("is_ambiguous"),
    )


def token_vi_ambiguous(tokens: DataFrame) -> DataFrame:
    return tokens.where("is_ambiguous").select("member_token")


def identify(lines: DataFrame, tokens: DataFrame) -> DataFrame:
    """Left join to the resolved tokens; one row per token, so no line is multiplied.

    No join hint: the token table grows with the population. Read from a written table, Spark
    broadcasts it while its files are small and otherwise splits the partitions of hot tokens, NULL
    included; it does not split a join right above the aggregation that resolves the tokens.
    """
    known = tokens.where(F.col("member_token").isNotNull()).select(
        F.col("member_token").alias("_graph_token"),
        "vi_pid",
        F.col("is_ambiguous").alias("_graph_ambiguous"),
    )
    joined = lines.join(known, F.col("member_token") == F.col("_graph_token"), "left")
    in_graph = F.col("_graph_token").isNotNull()
    return joined.select(
        *lines.columns,
        "vi_pid",
        in_graph.alias("_token_known"),
        F.coalesce(F.col("_graph_ambiguous"), F.lit(False)).alias("_token_ambiguous"),
        (~in_graph & ~blank(F.col("member_token"))).alias("_token_unresolved"),
    )


def accepted(lines: DataFrame, decisions: DataFrame) -> DataFrame:
    """Lines of the deliveries that were not blocked; the decisions hold one row per delivery.

    Over a table partitioned by delivery, Spark turns the broadcast side into a partition filter.
    """
    loaded = decisions.where(F.col("decision") != "BLOCK").select("_delivery_month")
    return lines.join(F.broadcast(loaded), "_delivery_month", "left_semi")


def attach_identity(lines: DataFrame, decisions: DataFrame, tokens: DataFrame) -> DataFrame:
    """Accepted lines with their person id and token flags."""
    return identify(accepted(lines, decisions), tokens)


def token_patient_ambiguous(lines: DataFrame) -> DataFrame:
    """Tokens the vendor sent with more than one patient id."""
    pairs = lines.where(F.col("member_token").isNotNull()).select("member_token", "patient_id").distinct()
    return (
        pairs.groupBy("member_token")
        .agg(F.count("patient_id").alias("patient_count"))
        .where(F.col("patient_count") > 1)
    )


def token_resolution_rate(lines: DataFrame, tokens: DataFrame) -> DataFrame:
    """Share of all lines of a delivery whose token is known and unambiguous.

    Lines are counted per delivery and token first, so a hot token reaches the join as one row per
    delivery.
    """
    counted = lines.groupBy("_delivery_month", "member_token").agg(F.count(F.lit(1)).alias("_lines"))
    usable = tokens.where(~F.col("is_ambiguous")).select("member_token", F.lit(True).alias("_usable"))
    resolved = F.sum(F.when(F.col("_usable"), F.col("_lines")).otherwise(F.lit(0)))
    return (
        counted.join(usable, "member_token", "left")
        .groupBy("_delivery_month")
        .agg((resolved.cast("double") / F.sum("_lines")).alias("token_resolution_rate"))
    )
