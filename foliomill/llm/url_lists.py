"""URL filters over time: dated list entries become validity intervals, and captures meet those of their fetch time.

All in DataFrame functions. Time is cut into periods, and an interval into pieces: one for each period with an entry,
and for those between them blocks of 1, 2, 4, ... periods, so that a long interval has few pieces however far it reaches.
The as-of join is an equality on key, block length and block with two comparisons inside; a key that very many captures
or entries share is split by period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomill.llm.components import stored

PERIOD_SECONDS = 30 * 86400
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """Host in lower case; empty for null and for other texts."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def url_key(url: Column) -> Column:
    """Host and path without the last slashes, scheme, query and fragment; with a slash at the end, so no host is equal to it."""
    path = F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/+$", "")
    return F.concat(url_host(url), path, F.lit("/"))


def lookup_keys(url: Column, most_labels: int) -> Column:
    """Keys under which lists may hold a URL: its host and parent domains of at most ``most_labels`` labels, and itself."""
    parts = F.split(url_host(url), r"\.")
    n = F.size(parts)
    starts = F.sequence(F.greatest(F.lit(1), n - most_labels + 1), n)
    domains = F.transform(starts, lambda i: F.array_join(F.slice(parts, i, n), "."))
    return F.when(url_host(url) != "", F.array_append(domains, url_key(url))).otherwise(F.array().cast("array<string>"))


def blocks(first: Column, last: Column) -> Column:
    """The fewest blocks ``(level, block)`` of ``2^level`` periods that make up the periods ``first`` to ``last``."""
    shifted = lambda value, level: F.call_function("shiftright", value, level)

    def of_level(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        low, high = shifted(first + size - 1, level), shifted(last + 1, level)
        odd = lambda value: (low < high) & (F.pmod(value, F.lit(2)) == 1)
        block = lambda at: F.struct(level.alias("level"), at.alias("block"))
        return F.array_compact(F.array(F.when(odd(low), block(low)), F.when(odd(high), block(high - 1))))

    levels = F.sequence(F.lit(0), F.floor(F.log2(last - first + 1)).cast("int"))
    return F.when(first <= last, F.flatten(F.transform(levels, of_level)))


def validity(entries: DataFrame, last_period: Column | int, period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """``_list, _key, _level, _block, _from, _to``: pieces of the intervals in which an entry holds.

    ``entries`` has ``list, key, at, action`` with ``add`` or ``remove``; an added entry holds from its time to the next
    removal, without that to the end of ``last_period``. At equal times a removal wins; repeated additions and removals
    change nothing. Rows with a null or another action are left out. Times of a key that are equal are combined before
    any shuffle, and the rows of a key are dealt out by period with the state carried in.
    """
    known = entries.filter(F.col("action").isin("add", "remove"))
    for name in ("list", "key", "at"):
        known = known.filter(F.col(name).isNotNull())
    period = F.floor(F.col("_at") / period_seconds).cast("bigint")
    events = known.groupBy(F.col("list").alias("_list"), F.col("key").alias("_key"), F.col("at").cast("bigint").alias("_at")).agg(
        (F.max("action") == "add").alias("_on")
    )
    events = events.withColumn("_period", period)
    # state at the end of every period with entries, and the next of these periods
    ends = events.groupBy("_list", "_key", "_period").agg(F.max_by("_on", "_at").alias("_on"))
    by_key = Window.partitionBy("_list", "_key").orderBy("_period")
    ends = ends.withColumn("_next", F.lead("_period").over(by_key)).filter("_on")
    # it opens that next period, and holds in all periods between the two
    opening = ends.filter("_next IS NOT NULL").select(
        "_list", "_key", (F.col("_next") * period_seconds).alias("_at"), "_on", F.col("_next").alias("_period")
    )
    between = blocks(F.col("_period") + 1, F.coalesce(F.col("_next") - 1, F.lit(last_period)))
    carried = ends.select("_list", "_key", F.inline(between).alias("_level", "_block"))
    length = F.call_function("shiftleft", F.lit(period_seconds).cast("bigint"), F.col("_level"))
    carried = carried.withColumn("_from", F.col("_block") * length).withColumn("_to", F.col("_from") + length)
    states = events.unionByName(opening).groupBy("_list", "_key", "_period", "_at").agg(F.min("_on").alias("_on"))
    inside = Window.partitionBy("_list", "_key", "_period").orderBy("_at")
    end = (F.col("_period") + 1) * period_seconds
    pieces = states.withColumn("_to", F.coalesce(F.lead("_at").over(inside), end)).filter("_on")
    pieces = pieces.select("_list", "_key", F.lit(0).alias("_level"), F.col("_period").alias("_block"), F.col("_at").alias("_from"), "_to")
    return pieces.unionByName(carried)


def active_entries(
    captures: DataFrame, entries: DataFrame, id_column: str, url_column: str, time_column: str, period_seconds: int = PERIOD_SECONDS
) -> DataFrame:
    """One row per capture: ``<id_column>, <time_column>, host, n_entries, lists, blocked``.

    ``lists`` are the names, in order, of the lists that hold the host, a parent domain or the URL at the fetch time (in
    seconds); ``n_entries`` counts list and key. A null or malformed URL and a null time match nothing. Null ids and
    repeated rows stay rows of their own. Without entries nothing is blocked; without captures the result is empty. Other
    columns are not read.
    """
    rows = captures.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_column).alias("_id"),
        F.col(url_column).alias("_url"),
        F.col(time_column).cast("bigint").alias("_time"),
    )
    period = F.floor(F.col("_time") / period_seconds).cast("bigint")
    last = rows.agg(F.max(period)).first()[0]
    pieces = stored(validity(entries, 0 if last is None else last, period_seconds), "list-pieces")
    levels = sorted(r[0] for r in pieces.select("_level").distinct().collect()) or [0]  # 63 at most
    most_labels = entries.agg(F.max(F.size(F.split("key", r"\.")))).first()[0] or 1
    # the row itself goes along under a key of its own, so that captures are read once
    own = F.concat(F.lit("\u0000"), F.col("_row").cast("string"))
    probes = rows.withColumns({"_key": F.explode(F.concat(F.array(own), lookup_keys(F.col("_url"), most_labels))), "_period": period})
    probes = probes.withColumn("_host", F.when(F.col("_key").startswith("\u0000"), url_host(F.col("_url"))))
    # a row's own key is met by nothing and needs one level only
    asked = F.when(F.col("_host").isNull(), F.array(*map(F.lit, levels))).otherwise(F.array(F.lit(0)))
    probes = probes.select("_row", "_key", "_time", "_id", "_host", "_period", F.explode(asked).alias("_level"))
    probes = probes.withColumn("_block", F.call_function("shiftright", F.col("_period"), F.col("_level"))).drop("_period")
    is_row = F.col("_host").isNotNull()
    holds = (F.col("_from") <= F.col("_time")) & (F.col("_time") < F.col("_to"))
    met = probes.alias("p").join(
        pieces.alias("v"),
        (F.col("p._key") == F.col("v._key"))
        & (F.col("p._level") == F.col("v._level"))
        & (F.col("p._block") == F.col("v._block"))
        & holds,
        "left",
    )
    met = met.filter(is_row | F.col("_list").isNotNull())
    per_row = met.groupBy("_row").agg(
        F.max(F.when(is_row, F.col("_id"))).alias(id_column),
        F.max(F.when(is_row, F.col("_time"))).alias(time_column),
        F.max("_host").alias("host"),
        F.count("_list").alias("n_entries"),
        F.array_sort(F.collect_set("_list")).alias("lists"),
    )
    return per_row.select(id_column, time_column, "host", "n_entries", "lists", (F.col("n_entries") > 0).alias("blocked"))
