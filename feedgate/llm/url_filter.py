"""Operator 10: URL filters as a temporal list join, in DataFrame operations only.

The list is a log of dated entries (``rule``, ``day``, ``action`` block, allow or remove). A rule is a host name, which
also covers its subdomains, or a host followed by a path prefix of whole segments. Each rule's entries become
validity intervals, open at the end for the last one. A capture is looked up under every rule that could cover
its URL, as of the day it was fetched; among the active entries the longest rule decides.

The as-of join is an equi-join on rule and period: an interval is listed once in every period it touches, so
a rule with many entries or many captures is spread over the periods, and at most one interval of a rule
holds a day. Captures are first reduced to distinct (host, path) and day.

Defined results: a null or unparsable URL, or a null fetch day, matches nothing (``action`` null). Of several
entries of a rule on one day the strictest counts: block, then allow, then remove. Entries with a null rule,
day or action are ignored. Repeated captures each get their Repeated captures each get their result. Of a very long host or path only
as many labels and segments are looked at as the longest rule has. With an empty
list nothing matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedgate.plans.workspace import Workspace

PERIOD_DAYS = 64


def host_of(url: Column) -> Column:
    """Lower-case host without user, port or final dot; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1)
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host == "", None).otherwise(host)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """``rule, action, from_day, to_day`` (exclusive, null if still valid), without the removed spans."""
    strict = F.expr("case action when 'block' then 0 when 'allow' then 1 when 'remove' then 2 end")
    known = entries.select("rule", F.col("day").cast("date").alias("day"), strict.alias("order"))
    daily = known.where("rule is not null and day is not null and order is not null")
    daily = daily.groupBy("rule", "day").agg(F.min("order").alias("order"))
    after = F.lead("day").over(Window.partitionBy("rule").orderBy("day"))
    spans = daily.select("rule", "order", F.col("day").alias("from_day"), after.alias("to_day"))
    action = F.when(F.col("order") == 0, "block").otherwise("allow")
    return spans.where("order < 2").select("rule", action.alias("action"), "from_day", "to_day")


def rules_of(host: str, path: str, labels: str, segments: str) -> Column:
    """Every rule that would cover the URL: parent domains, and path prefixes of the host itself.

    Only as many host labels and path segments are looked at as the longest rule has, each once.
    """
    none = "cast(array() as array<string>)"
    return F.expr(
        f"""concat(
            aggregate(slice(reverse(split({host}, '[.]')), 1, {labels}),
                named_struct('at', '', 'rules', {none}),
                (s, x) -> named_struct(
                    'at', concat('.', x, s.at),
                    'rules', concat(s.rules, array(concat(x, s.at)))),
                s -> s.rules),
            case when {path} like '/%' then
                aggregate(slice(split({path}, '/'), 2, {segments}),
                    named_struct('at', {host}, 'rules', {none}),
                    (s, x) -> named_struct(
                        'at', concat(s.at, '/', x),
                        'rules', if(x = '', s.rules, concat(s.rules, array(concat(s.at, '/', x))))),
                    s -> s.rules)
                else {none} end)"""
    )


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``page_id, url, fetch_day, rule, action, from_day`` for every row of ``captures(page_id, url, fetch_day)``."""
    keep = Workspace(captures.sparkSession, "url-filter").keep
    url = F.col("url").cast("string")
    rows = captures.select("page_id", url.alias("url"), F.col("fetch_day").cast("date").alias("fetch_day"))
    rows = rows.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    asked = rows.where("host is not null and fetch_day is not null").select("host", "path", "fetch_day").distinct()
    last = captures.agg(F.max(F.col("fetch_day").cast("date")).alias("last"))
    spans = intervals(entries).crossJoin(F.broadcast(last)).where("from_day <= last")
    ends = F.least(F.coalesce(F.date_sub("to_day", 1), F.col("last")), F.col("last"))
    spans = spans.select(
        "rule",
        "action",
        "from_day",
        "to_day",
        F.explode(
            F.sequence(F.floor(F.unix_date("from_day") / PERIOD_DAYS), F.floor(F.unix_date(ends) / PERIOD_DAYS))
        ).alias("period"),
    )
    spans = keep("spans", spans)
    # One row: the most labels and path segments of any rule bound what is made of a URL, however long it is.
    most = spans.selectExpr(
        "coalesce(max(size(split(substring_index(rule, '/', 1), '[.]'))), 0) as labels",
        "coalesce(max(size(split(rule, '/')) - 1), 0) as segments",
    )
    asked = asked.crossJoin(F.broadcast(most)).select(
        "host",
        "path",
        "fetch_day",
        F.floor(F.unix_date("fetch_day") / PERIOD_DAYS).alias("period"),
        F.explode(rules_of("host", "path", "labels", "segments")).alias("rule"),
    )
    active = asked.join(spans, ["rule", "period"]).where("from_day <= fetch_day and (to_day is null or fetch_day < to_day)")
    longest = F.max_by(F.struct("rule", "action", "from_day"), F.struct(F.length("rule"), "rule")).alias("hit")
    verdicts = keep("verdicts", active.groupBy("host", "path", "fetch_day").agg(longest))
    return rows.join(verdicts, ["host", "path", "fetch_day"], "left").select(
        "page_id", "url", "fetch_day", "hit.rule", "hit.action", "hit.from_day"
    )
