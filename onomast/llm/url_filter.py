"""URL allow and block rules by a sort-merge range join.

A rule ``host/path`` fits its host and all subdomains where the url's path starts with the rule's path. With the labels
of a host reversed (``blog.example.net`` becomes ``net.example.blog.``) a rule's host is a prefix of every host it fits,
so each rule opens an interval of keys, and any two intervals are nested or apart. Urls and rules are sorted together by
that key; one sweep in key order carries the stack of nested rules opened last. A rule that is still open at a url opened
before it and contains it, so it is the rule opened last or one of those around it: the stack of that rule, less those
whose interval has ended, is the set of rules that fit. Only DataFrame operations are used.

The sweep is cut into blocks of the first two labels. Rules are copied into the blocks they reach; a block that holds
more than half a task's share of the urls is dealt over several tasks, each with the block's rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onomast.llm.common import ascii_lower, hot_limit

#: (action, host, path)
Rule = tuple[str, str, str]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def first_labels(key: Column, n: int) -> Column:
    return F.regexp_extract(key, rf"^(?:[^.]*\.){{1,{n}}}", 0)


def rules_frame(spark, rules: Sequence[Rule]) -> DataFrame:
    rows = [F.struct(F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path")) for a, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows))) if rows else spark.createDataFrame([], "action string, host string, path string")


def _stacks(rules: DataFrame) -> DataFrame:
    """For each rule host: its key and the rules of that host and of all hosts around it."""
    rules = rules.select("action", ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path")).where("host is not null and host <> '' and action is not null")
    entry = F.struct(
        F.length(F.concat("host", "path")).alias("length"), F.length("host").alias("host_length"), (F.col("action") == "block").alias("blocks"),
        F.concat("host", "path").alias("rule"), "action", reversed_key(F.col("host")).alias("open"), "path",
    )
    hosts = rules.groupBy(reversed_key(F.col("host")).alias("key")).agg(F.collect_set(entry).alias("own"))
    depth = F.size(F.split("key", r"\.")) - 1
    around = hosts.select("key", F.explode(F.transform(F.sequence(F.lit(1), depth), lambda i: F.concat(F.array_join(F.slice(F.split("key", r"\."), F.lit(1), i), "."), F.lit(".")))).alias("outer"))
    return around.join(hosts.select(F.col("key").alias("outer"), "own"), "outer").groupBy("key").agg(F.flatten(F.collect_list("own")).alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Judge every row of ``pages``: its id (as ``id_col``), ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has columns action, host and path. The longest rule that fits decides; of equally long ones that with the
    longer host, then block before allow. Without one the verdict is ``default`` and the rule null. A null url or one
    without ``://`` has an empty host, which no rule fits. Repeated rows, null ids and equal urls are judged each; other
    columns of ``pages`` play no part, whatever their names. An empty table gives an empty result. The work a url is
    linear in the rules that nest over its host.
    """
    spark = pages.sparkSession
    host, path = split_url(F.col("u"))
    key = reversed_key(F.col("host"))
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u")).select("id", host.alias("host"), path.alias("path"))
    # rows are dealt by their place in the input, so that rows repeated very often are dealt too
    urls = urls.withColumn("key", key).withColumn("block", first_labels(F.col("key"), 2)).withColumn("number", F.monotonically_increasing_id())
    limit = hot_limit(spark, pages.count())
    blocks = urls.drop("number").groupBy("block").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("tasks"))
    hot = F.broadcast(blocks.where("tasks > 1"))  # at most twice the number of shuffle partitions
    urls = urls.join(hot, "block", "left").withColumn("task", F.coalesce(F.pmod("number", F.col("tasks")), F.lit(0)))

    stacks = _stacks(rules).withColumn("block", first_labels(F.col("key"), 2))
    reach = blocks.withColumn("top", first_labels(F.col("block"), 1))
    narrow = stacks.join(reach.drop("top"), "block")
    wide = stacks.where(F.col("key") == first_labels(F.col("key"), 1)).withColumnRenamed("block", "top").join(reach.where("block <> top"), "top")
    opened = narrow.select("block", "tasks", "key", "stack").unionByName(wide.select("block", "tasks", "key", "stack"))
    opened = opened.withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))

    none = F.lit(None)
    stack_type = dict(opened.dtypes)["stack"]
    both = urls.select("block", F.col("task").cast("long").alias("task"), "key", F.lit(1).alias("is_url"), "id", "host", "path", none.cast(stack_type).alias("stack")).unionByName(
        opened.select("block", F.col("task").cast("long").alias("task"), "key", F.lit(0).alias("is_url"), none.cast(dict(urls.dtypes)["id"]).alias("id"), none.cast("string").alias("host"), none.cast("string").alias("path"), "stack")
    )
    sweep = Window.partitionBy("block", "task").orderBy("key", "is_url").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("is_url = 1")
    fits = F.array_max(F.filter("stack", lambda r: F.startswith(F.col("key"), r["open"]) & F.startswith(F.col("path"), r["path"])))
    return swept.withColumn("best", fits).select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )
