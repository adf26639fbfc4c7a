"""URL rules by a sort-merge range join.

A rule (host, path) fits a host, its subdomains, and paths that begin with the rule's. Under one host, rules are prefixes, that is
nested intervals of path keys. A sorted sweep over the interval ends keeps the stack of active rules; here the stack is worked out once
per interval end, so that each end names the innermost rule that holds from there on. Urls are put under every parent of their host that has rules, and
sorted among the interval ends: the last end before a url names its rule there. Of all parents, the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Urls of one host are dealt to so many sweeps; the rules of a host are copied to each.
SPREAD = 64
#: The verdict where no rule fits.
OTHERWISE = "allow"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lower = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """org.example.www, the order in which a host stands next to its subdomains."""
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def parents(host: Column) -> Column:
    """The reversed host's prefixes: org, org.example, org.example.www."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, F.lit(1), n), "."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """From (verdict, host, path) to the columns that judge() reads, without a Python worker."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    listed = F.array(*rows).cast("array<struct<verdict: string, host: string, path: string>>")
    return spark.range(1).select(F.inline(listed))


def interval_ends(rules: DataFrame) -> DataFrame:
    """(domain, at, rule, verdict): from key `at` on, this is the innermost rule of the domain; null where none is left.

    An interval runs from the path's bytes to those bytes and 0xFF, which no text holds. Where it ends, the rule around it holds again.
    """
    named = (rules.select(reversed_host(F.col("host")).alias("domain"), F.col("path"), F.concat("host", "path").alias("rule"), "verdict")
             .groupBy("domain", "path").agg(F.min_by(F.struct("rule", "verdict"), "verdict").alias("r")))
    shorter = F.when(F.length("path") > 0, F.sequence(F.lit(0), F.length("path") - 1)).otherwise(F.array().cast("array<int>"))
    prefixes = named.select("domain", "path", F.explode(F.transform(shorter, lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("outer"))
    around = (prefixes.join(named.select("domain", F.col("path").alias("outer"), F.col("r").alias("o")), ["domain", "outer"])
              .groupBy("domain", "path").agg(F.max_by("o", F.length("outer")).alias("o")))
    key = F.encode("path", "utf-8")
    opens = named.select("domain", key.alias("at"), "r.rule", "r.verdict")
    closes = named.join(around, ["domain", "path"], "left").select("domain", F.concat(key, F.unhex(F.lit("FF"))).alias("at"), "o.rule", "o.verdict")
    # Intervals that end at one key: the outermost one's successor holds.
    last = closes.groupBy("domain", "at").agg(F.min_by(F.struct("rule", "verdict"), F.coalesce(F.length("rule"), F.lit(-1))).alias("x"))
    return opens.unionByName(last.select("domain", "at", "x.rule", "x.verdict"))


def matches(places: DataFrame, rules: DataFrame, spread: int = SPREAD) -> DataFrame:
    """places (host, path), different rows -> (host, path, rule, verdict) of those that a rule fits: the longest rule's.

    Of rules of equal length, the one of the longer host wins; of equal rules, allow wins.
    """
    ends = interval_ends(rules)
    under = places.select("host", "path", F.explode(parents(F.col("host"))).alias("domain"))
    known = under.join(rules.select(reversed_host(F.col("host")).alias("domain")).distinct(), "domain", "left_semi")
    none = F.lit(None).cast("string")
    asked = known.select("domain", F.pmod(F.xxhash64("host", "path"), F.lit(spread)).cast("int").alias("part"), F.encode("path", "utf-8").alias("at"),
                         F.lit(1).alias("turn"), "host", "path", none.alias("rule"), none.alias("verdict"))
    marks = ends.select("domain", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"), "at", F.lit(0).alias("turn"),
                        none.alias("host"), none.alias("path"), "rule", "verdict")
    # Of marks and urls in order of key, marks first: the last mark so far. A struct keeps marks without a rule apart from no mark.
    sweep = Window.partitionBy("domain", "part").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = F.last(F.when(F.col("turn") == 0, F.struct("rule", "verdict")), ignorenulls=True).over(sweep)
    swept = asked.unionByName(marks).withColumn("active", active).where("turn = 1 and active.rule is not null")
    rank = F.struct(F.length("active.rule"), F.length("domain"), F.col("active.rule"))
    return swept.groupBy("host", "path").agg(F.max_by("active", rank).alias("a")).select("host", "path", "a.rule", "a.verdict")


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", otherwise: str = OTHERWISE, spread: int = SPREAD) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row; rule is null where none fits.

    A null url and one without "://" have an empty host and path, which only a rule with an empty host and path fits. Equal places
    are judged once, so a host or url that many rows share costs one row. Rules with null fields are ignored.
    """
    whole = rules.where("host is not null and path is not null and verdict is not null")
    placed = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    found = matches(placed.select("host", "path").distinct(), whole, spread)
    return placed.join(found, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))
