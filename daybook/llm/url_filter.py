"""URL filters over dated lists: a temporal join of captures with validity intervals.

List changes (a target is put on a list or taken off it at a time) become intervals of
validity. Every capture is joined with the intervals of the targets its URL falls under
that hold its fetch time. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import slices_for, staged


def host_of(url: Column) -> Column:
    """The host of a URL in small letters, without user, port and a last dot; else empty."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.regexp_replace(F.lower(host), r"\.$", "")


def section_of(url: Column) -> Column:
    """The first segment of the path, else empty."""
    return F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1
    )


def targets_of(url: Column) -> Column:
    """What a URL falls under: its host, every parent domain, and host/first segment."""
    host, section = host_of(url), section_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    path = F.when(section != "", F.array(F.concat(host, F.lit("/"), section))).otherwise(
        F.array().cast("array<string>")
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(parents, path))
    )


def validity(changes: DataFrame) -> DataFrame:
    """Intervals (list, target, since, until) from changes (list, target, at, action).

    ``action`` is ``add`` or ``remove``; of changes at the same time a removal wins. An
    interval holds its start and not its end; the last one is open (null). Rows with a
    null in any of the four are not used. Of a target with very many changes each day is
    put in order by itself, and days among each other by their first change.
    """
    known = (
        changes.where("list is not null and target is not null and at is not null and "
                      "action in ('add', 'remove')")
        .groupBy("list", "target", "at").agg(F.max("action").alias("action"))
        .withColumn("_day", F.to_date("at"))
    )
    days = known.groupBy("list", "target", "_day").agg(F.min("at").alias("_first"))
    days = days.withColumn(
        "_later", F.lead("_first").over(Window.partitionBy("list", "target").orderBy("_day"))
    ).drop("_first")
    within = Window.partitionBy("list", "target", "_day").orderBy("at")
    return (
        known.withColumn("_next", F.lead("at").over(within))
        .join(days, ["list", "target", "_day"])
        .where("action = 'add'")
        .select("list", "target", F.col("at").alias("since"), F.coalesce("_next", "_later").alias("until"))
    )


def _month(time: Column) -> Column:
    return F.year(time) * 12 + F.month(time)


def filter_captures(captures: DataFrame, changes: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    time_col: str = "fetched_at") -> DataFrame:
    """One row per capture: id, url, time, host, entries, target, verdict.

    ``entries`` are the active entries as sorted ``list:target`` texts. The longest active
    target decides, of a target on several lists ``allow`` wins; ``verdict`` is that list's
    name, or ``none``.

    * A null URL or one without a host, and a null time, meet no entry.
    * Ids may be null and rows may be repeated: each row gets a row of its own.
    * Without captures there are no rows, without changes every verdict is ``none``. Other
      columns are ignored.
    * Captures of a hot target are dealt over slices, and its intervals go to each slice. A
      capture meets only the intervals of its own month, however many a target has.
    """
    rows = staged(
        captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).alias("time"))
        .withColumn("row", F.monotonically_increasing_id()),
        "url-captures",
    )
    slices = slices_for(rows.count())
    first, last = rows.agg(F.min(_month(F.col("time"))), F.max(_month(F.col("time")))).first()
    asked = rows.where("time is not null").select(
        "row", "time", _month(F.col("time")).alias("month"), F.explode(targets_of(F.col("url"))).alias("target"),
        F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice"),
    )
    # An interval once per month of the captures that it touches.
    months = validity(changes).withColumns({
        "_from": F.greatest(_month(F.col("since")), F.lit(first)),
        "_to": F.least(F.coalesce(_month(F.col("until")), F.lit(last)), F.lit(last)),
    }).where("_from <= _to").withColumn("month", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")
    slots = asked.select("target", "slice", "month").distinct()
    dealt = slots.join(months, ["target", "month"])
    met = asked.join(dealt, ["target", "slice", "month"]).where(
        "since <= time and (until is null or time < until)"
    )
    found = met.groupBy("row").agg(
        F.array_sort(F.collect_set(F.concat("list", F.lit(":"), "target"))).alias("entries"),
        F.max(F.struct(F.length("target").alias("long"), (F.col("list") == "allow").alias("allow"),
                       F.col("target").alias("target"), F.col("list").alias("list"))).alias("best"),
    )
    return rows.join(found, "row", "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("time").alias(time_col),
        host_of(F.col("url")).alias("host"),
        F.coalesce("entries", F.array().cast("array<string>")).alias("entries"),
        F.col("best.target").alias("target"), F.coalesce("best.list", F.lit("none")).alias("verdict"),
    )
