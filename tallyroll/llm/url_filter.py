"""Verdicts on URLs by nested rules: a sort-merge range join with a stack of open rules.

A rule is a host, a path and an action. It fits a URL whose host is the rule's or lies below it and
whose path starts with the rule's; of those that fit the longest wins (host and path counted in
code points, then the longer host).

Keys: the labels of a host in reverse order, each followed by ``/`` (``net/example/``). A label holds no
``/``, so "a host or any below it" is a prefix, and a prefix ``p`` is the interval from ``p`` to ``p`` and
the byte FF, which no UTF-8 text has. Two intervals of prefixes are nested or apart.

Sweep (``open_rules``): points and intervals are sorted together by key. The rules that are open at a
point are the last rule begun before it and the rules around that one, as far as they have not ended. Each
rule brings its stack along (itself and the rules around it, an equality join on the prefixes of its
key), so what is carried from row to row is the last stack seen, with a carry from each range of
keys to the next, and the ended rules are popped by comparing keys.

Two sweeps: the first one puts the distinct hosts among the hosts of the rules. For each host that
is open the URL's path is then looked for among the paths of that host's rules by the second one. So rules
nest in both parts, a host may have any number of rules, and no rule is tried on a URL it can't fit
by host. Everything works on distinct hosts and (host, path) pairs; copies of a URL, be they a third of
the table, meet their verdict in ``lookup_join`` (broadcast by measured size, else hot keys are cut).

Defined results: one row for each page, repeated rows too. The host is what follows the first ``://``
up to ``/``, ``?``, ``#`` or the end, A-Z in lower case, with port and user if there are any; the path what
follows up to ``?``, ``#`` or the end. A null URL or one without ``://`` has both empty, and no rule fits. A
null rule host or path is empty; a rule with an empty host fits none, a rule with ``?`` or ``#`` in its path or one of ``/?#`` in its host neither. Of
equal rules with different actions ``block`` counts. No rules: all URLs have the default verdict.
Other columns are not read. A page_id may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroll.operators.joins import BROADCAST_BYTES, lookup_join, measured_bytes
from tallyroll.session import settle

RULES = "host string, path string, action string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Between host and path in a key: neither has it.
PATH_MARK = "?"
# monotonically_increasing_id() keeps the partition number above this many bits.
_SLICE_BITS = 33


def lower(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, UPPER, LOWER)


def _until(text: Column, *stops: str) -> Column:
    for stop in stops:
        text = F.substring_index(text, stop, 1)
    return text


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = _until(rest, "/", "?", "#")
    return lower(host), _until(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), "?", "#")


def host_key(host: Column) -> Column:
    """Reversed labels, each followed by a slash."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/"))


def clean_rules(rules: DataFrame) -> DataFrame:
    """``host, path, action`` of the rules that can fit some URL, one of each host and path."""
    host = lower(F.coalesce(F.col("host").cast("string"), F.lit("")))
    path = F.coalesce(F.col("path").cast("string"), F.lit(""))
    some = rules.select(host.alias("host"), path.alias("path"), F.col("action").cast("string").alias("action"))
    fit = some.where((F.col("host") != "") & ~F.col("host").rlike("[/?#]") & ~F.col("path").rlike("[?#]"))
    return fit.groupBy("host", "path").agg(F.max("action").alias("action"))


def host_stacks(hosts: DataFrame) -> DataFrame:
    """``key, stack`` of rule hosts: the keys of the host and of the rule hosts above it, outermost first."""
    labels = F.split(F.col("key"), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "/"), F.lit("/")))
    return _stacks(hosts.select("key", F.explode(above).alias("prefix")), hosts)


def path_stacks(rules: DataFrame) -> DataFrame:
    """``key, stack`` of rules keyed by host and path: those of the same host whose path the rule's path starts with."""
    stem = F.length(F.substring_index("key", PATH_MARK, 1)) + 1
    above = F.transform(F.sequence(stem, F.length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n))
    return _stacks(rules.select("key", F.explode(above).alias("prefix")), rules)


def _stacks(prefixes: DataFrame, keyed: DataFrame) -> DataFrame:
    found = prefixes.join(keyed.select(F.col("key").alias("prefix")), "prefix")
    # A prefix is shorter than what it is a prefix of, hence sorts before it.
    return found.groupBy("key").agg(F.sort_array(F.collect_list("prefix")).alias("stack"))


def open_rules(points: DataFrame, stacks: DataFrame) -> DataFrame:
    """``points`` (distinct ``key`` and other columns) with ``open``: the keys of the rules open at each, outermost first.

    Rows are range-partitioned by key and written down, so a slice of the key space is a task; the last stack
    of each slice is carried on in a table of one row for each slice.
    """
    # Where a rule begins at the very key of a point, it is open there.
    point = points.select("key", F.lit(1).alias("_kind"), F.struct(*[c for c in points.columns if c != "key"]).alias("_row"), F.lit(None).cast("array<string>").alias("_stack"))
    rule = stacks.select("key", F.lit(0).alias("_kind"), F.lit(None).cast(point.schema["_row"].dataType).alias("_row"), F.col("stack").alias("_stack"))
    placed = settle(
        point.unionByName(rule).repartitionByRange("key", "_kind").sortWithinPartitions("key", "_kind").withColumn("_place", F.monotonically_increasing_id()), "sweep"
    ).withColumn("_slice", F.shiftright("_place", _SLICE_BITS))
    slices = placed.groupBy("_slice").agg(F.max_by("_stack", F.when(F.col("_stack").isNotNull(), F.col("_place"))).alias("_last"))
    # One row for each task of the sort.
    before = Window.partitionBy().orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("_slice", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    if measured_bytes(carried.select("_slice")) <= BROADCAST_BYTES // 16:
        carried = F.broadcast(carried)
    inside = Window.partitionBy("_slice").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = placed.withColumn("_seen", F.last("_stack", ignorenulls=True).over(inside)).where("_kind = 1")
    stack = F.coalesce("_seen", "_carried", F.array().cast("array<string>"))
    popped = F.filter(stack, lambda key: F.col("key").startswith(key))
    return seen.join(carried, "_slice").select("key", "_row.*", popped.alias("open"))


def verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, action`` for those of the distinct ``urls`` (host, path) that a rule fits."""
    rules = settle(clean_rules(rules).select(host_key(F.col("host")).alias("host_key"), "*"), "url-rules")
    keyed = rules.select(F.concat("host_key", F.lit(PATH_MARK), "path").alias("key"), "host_key", F.concat("host", "path").alias("rule"), "action", F.length("host").alias("of_host"))
    hosts = urls.select("host").distinct().select(host_key(F.col("host")).alias("key"), "host")
    among = settle(open_rules(hosts, host_stacks(rules.select(F.col("host_key").alias("key")).distinct())).where(F.size("open") > 0).select("host", "open"), "url-hosts")
    tried = lookup_join(urls, among, ["host"], ["path"], how="inner").select("host", "path", F.explode("open").alias("host_key"))
    tried = settle(tried, "url-tried")
    points = tried.select("host_key", "path").distinct().select(F.concat("host_key", F.lit(PATH_MARK), "path").alias("key"), "host_key", "path")
    inner = open_rules(points, path_stacks(keyed.select("key"))).where(F.size("open") > 0)
    # The innermost rule of each open host is the longest of that host.
    fits = inner.select("host_key", "path", F.try_element_at("open", F.lit(-1)).alias("key")).join(keyed.drop("host_key"), "key").drop("key")
    fits = settle(fits, "url-fits")
    fitted = lookup_join(tried, fits, ["host_key", "path"], ["host"], how="inner")
    best = F.max(F.struct(F.length("rule").alias("n"), "of_host", "rule", "action"))
    return fitted.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.action")


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict``: the longest rule that fits as host and path in one, null if none does, and its action or ``default``."""
    host, path = url_parts(F.col(f"`{url_col}`"))
    read = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    urls = settle(read.where("host <> ''").select("host", "path").distinct(), "urls")
    found = settle(verdicts(urls, rules), "url-verdicts")
    judged = lookup_join(read, found, ["host", "path"], ["page_id"])
    return judged.select("page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, action)."""
    return spark.createDataFrame(rules, RULES)
