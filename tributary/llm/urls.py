"""URL filter rules by a sort-merge range join.

Host labels are reversed, so a rule covers one interval of sorted keys and rules that
overlap are nested. A sorted sweep over rule starts, url keys and rule ends keeps the
stack of open rules: the running count of starts less ends is its depth, and the rule
on top at depth d is the last one that was opened at depth d.

A rule with a path also holds for the subdomains of its host, and these lie between the
host and the path in no one order: each url has one key for its host and for each parent
of it that a rule could name, and a sweep holds the paths of one host. Urls of hosts that
no rule names are not swept, a rule goes to the sweeps of its host only, and the urls of a
frequent host are dealt to several sweeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import staged

RULE_COLUMNS = "host string, path string, verdict string"
#: Urls of a host that one sweep takes; each sweep also sorts the rules of its host.
SWEEP_KEYS = 1_000_000


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, "\\.")), ".")


def _clean_rules(rules: DataFrame) -> DataFrame:
    """One rule per host and path; of contradicting rules block holds. Rules without host or verdict go."""
    return (rules.select(_ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
            .where("host <> '' and verdict is not null")
            .groupBy("host", "path").agg(F.max(F.struct((F.col("verdict") == "block").alias("b"), "verdict")).alias("v"))
            .select("host", "path", F.col("v.verdict").alias("verdict")))


def _sweep_sizes(points: DataFrame, rules: DataFrame, sweep_keys: int) -> DataFrame:
    """For each host of a rule that urls have: ``sweeps``, over how many its urls are dealt."""
    hosts = rules.select(_reversed(F.col("host")).alias("key_host")).distinct()
    return (points.groupBy("key_host").agg(F.count(F.lit(1)).alias("n")).join(hosts, "key_host")
            .select("key_host", F.ceil(F.col("n") / sweep_keys).cast("bigint").alias("sweeps")))


def _marks(rules: DataFrame, sizes: DataFrame) -> DataFrame:
    """Where rules begin and end: a rule goes to the sweeps of its host, and to no other."""
    start = F.col("path").cast("binary")
    placed = rules.withColumn("key_host", _reversed(F.col("host"))).join(sizes, "key_host")
    both = (placed.withColumn("sweep", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("sweeps") - 1)))
            .withColumn("kind", F.explode(F.array(F.lit(0), F.lit(2)))))
    opens = F.col("kind") == 0
    return both.select(
        "key_host", "sweep",
        # no UTF-8 text has the byte FF, so the end sorts behind all that starts like the rule
        F.when(opens, start).otherwise(F.concat(start, F.unhex(F.lit("FF")))).alias("key"),
        "kind", F.when(opens, 1).otherwise(-1).alias("delta"),
        F.when(opens, F.concat("host", "path")).alias("opened"), F.when(opens, F.col("verdict")).alias("opened_verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
               keep: tuple[str, ...] = (), sweep_keys: int = SWEEP_KEYS) -> DataFrame:
    """The ``keep`` columns of every row with host, path, rule and verdict.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all
    subdomains where the url's path starts with the rule's path. Of the fitting rules
    the longest (host and path together, then host) wins; without one the verdict is
    ``default``. A null url, or one without ``://``, has an empty host and path and no
    rule. Repeated rows stay repeated. No rules, or no pages, is fine.
    """
    spark = pages.sparkSession
    rules = _clean_rules(rules)
    depth_of_rules = rules.agg(F.max(F.size(F.split("host", "\\.")))).first()[0] or 0
    base = pages.select(*[F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)],
                        url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    base = base.withColumn("row", F.monotonically_increasing_id())
    labels = F.split("host", "\\.")
    levels = F.least(F.size(labels), F.lit(depth_of_rules))
    # the host's last 1, 2, .. labels, as many as a rule can have
    parents = F.when((F.col("host") != "") & (levels > 0), F.transform(
        F.sequence(F.lit(1), F.greatest(levels, F.lit(1))),
        lambda k: F.array_join(F.reverse(F.slice(labels, -k, k)), ".")))
    points = base.select("*", F.explode_outer(parents).alias("key_host"))
    sizes = staged(_sweep_sizes(points, rules, sweep_keys), "sweep-sizes")
    dealt = points.join(sizes, "key_host", "left").select(
        *base.columns, "key_host", F.pmod(F.xxhash64("row"), F.col("sweeps")).alias("sweep"),
        F.col("path").cast("binary").alias("key"), F.lit(1).alias("kind"), F.lit(0).alias("delta"),
        F.lit(None).cast("string").alias("opened"), F.lit(None).cast("string").alias("opened_verdict"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in base.schema]
    marks = _marks(rules, sizes).select(*blank, "key_host", "sweep", "key", "kind", "delta", "opened", "opened_verdict")
    order = [F.col("key"), F.col("kind")]
    sweep = Window.partitionBy("key_host", "sweep").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy("key_host", "sweep", "depth").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    top = F.struct(F.length("opened").alias("len"), F.size(F.split("key_host", "\\.")).alias("labels"),
                   F.col("opened").alias("rule"), F.col("opened_verdict").alias("verdict"))
    asked = dealt.where("sweep is not null")  # the others' hosts have no rules
    swept = (asked.unionByName(marks)
             .withColumn("depth", F.sum("delta").over(sweep))
             .withColumn("top", F.last(F.when(F.col("kind") == 0, top), ignorenulls=True).over(level))
             .where("kind = 1").withColumn("top", F.when(F.col("depth") > 0, F.col("top"))).select(*base.columns, "top"))
    none = F.lit(None).cast(swept.schema["top"].dataType).alias("top")
    swept = swept.unionByName(dealt.where("sweep is null").select(*base.columns, none))
    cols = [f.name for f in base.schema]
    best = swept.groupBy("row").agg(*[F.first(c).alias(c) for c in cols if c != "row"], F.max("top").alias("top"))
    return best.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "host", "path",
                       F.col("top.rule").alias("rule"),
                       F.coalesce(F.col("top.verdict"), F.lit(default)).alias("verdict"))
