"""URL filter by path-template trees.

Rules label the urls they fit. Per host a tree of path templates is grown from the root, one level of segments at a time:
numbers and long codes are wildcards from the start, a place with very many or hardly repeated segments becomes one wildcard, and sibling
branches that can't be told apart by their shares of labels and by how they go on become one branch. A template whose labelled
urls are mostly blocked, by a smoothed share, is rejected with all its urls.

Urls are counted by host and path shape before anything else; a level only groups and joins such counts. All but the last
join, back to the pages, are between counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnwatt.llm.common import phase, table
from kilnwatt.llm.decontaminate import _small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains, where the path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the contract.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Tree:
    """How trees are grown and judged.

    Segments beyond `depth` are one wildcard, `**`. A place is variable with more than `children` different segments, or
    with at least `few` of which the average occurs less than `repeats` times. Branches are alike if no share differs beyond
    the Hoeffding bound at level `alpha`. A template is rejected from a smoothed blocked share of `reject` on: `weight` urls
    are added, half of them blocked, so that a template without labels is never rejected.
    """

    depth: int = 8
    children: int = 32
    few: int = 4
    repeats: float = 2.0
    alpha: float = 0.05
    weight: float = 5.0
    reject: float = 0.7


#: Segments of more characters are a wildcard, which also bounds the length of a template.
LONG = 64


def located(pages: DataFrame) -> DataFrame:
    """Add host (after the first `://`, A-Z lower-cased) and path (up to `?` or `#`); both are empty if there is no `://`."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.char_length("url"))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return pages.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits host and path, or nulls. Of rules with one name, a block wins."""
    ordered = sorted(rules, key=lambda r: (len(r.name), r.verdict == "block"))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in ordered:  # later ones are asked first
        host = (F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")
        fits = host & F.col("path").startswith(rule.path)
        name, verdict = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def segments(path: Column, depth: int) -> Column:
    """The path's segments with wildcards for numbers (`{n}`), long hexadecimal codes (`{h}`) and long segments (`{l}`);
    an empty path has none."""
    one = lambda s: F.when(F.char_length(s) > LONG, F.lit("{l}")).otherwise(F.regexp_replace(F.regexp_replace(s, "[0-9A-Fa-f-]{16,}", "{h}"), "[0-9]+", "{n}"))
    parts = F.split(F.substring(path, F.lit(2), F.char_length(path)), "/", depth + 1)  # the last one has the rest
    named = F.transform(parts, lambda s, i: F.when(i == depth, F.lit("**")).otherwise(one(s)))
    return F.when(path == "", F.array().cast("array<string>")).otherwise(named)


def _differs(name: str, tree: Tree) -> Column:
    """Whether a share differs between a branch and the one before it by more than both counts allow."""
    order = Window.partitionBy("host", "template").orderBy("blocked_share", "allowed_share", "ending_share", "number_share", "segment")
    bound = (0.5 * F.log(F.lit(2 / tree.alpha))) ** 0.5 * (1 / F.sqrt("n") + 1 / F.sqrt(F.lag("n").over(order)))
    return F.coalesce(F.abs(F.col(name) - F.lag(name).over(order)) > bound, F.lit(False))


def _branches(active: DataFrame, level: int, tree: Tree) -> DataFrame:
    """(host, template, segment, part): the part of a template that each segment after it stands for; segment is null for
    a variable place, where all segments become `*`."""
    here, following = F.col("segments")[level], F.get("segments", F.lit(level + 1))
    number = F.coalesce(following.startswith("{"), F.lit(False))
    kids = active.groupBy("host", "template", here.alias("segment")).agg(
        F.sum("n").alias("n"),
        F.sum("blocked").alias("blocked"),
        F.sum("allowed").alias("allowed"),
        F.sum(F.when(following.isNull(), F.col("n")).otherwise(0)).alias("ending"),
        F.sum(F.when(number, F.col("n")).otherwise(0)).alias("number"),
    )
    kids = phase(kids, "urls-kids")
    places = kids.groupBy("host", "template").agg(F.count(F.lit(1)).alias("fan"), F.sum("n").alias("total"))
    variable = (F.col("fan") > tree.children) | ((F.col("fan") >= tree.few) & (F.col("total") < tree.repeats * F.col("fan")))
    places = phase(places.select("host", "template", variable.alias("variable")), "urls-places")
    wild = places.filter("variable").select("host", "template", F.lit(None).cast("string").alias("segment"), F.lit("*").alias("part"))
    fixed = kids.join(_small(places.filter("not variable")), ["host", "template"], "left_semi")
    names = ("blocked", "allowed", "ending", "number")
    for name in names:
        fixed = fixed.withColumn(f"{name}_share", F.col(name) / F.col("n"))
    # At most `children` rows for each place come into these windows.
    new = reduce(lambda a, b: a | b, [_differs(f"{name}_share", tree) for name in names])
    order = Window.partitionBy("host", "template").orderBy("blocked_share", "allowed_share", "ending_share", "number_share", "segment")
    fixed = fixed.withColumn("new", new.cast("int")).withColumn("branch", F.sum("new").over(order))
    members = F.array_sort(F.collect_list("segment").over(Window.partitionBy("host", "template", "branch")))
    part = F.when(F.size(members) > 1, F.concat(F.lit("{"), F.array_join(members, "|"), F.lit("}"))).otherwise(F.col("segment"))
    return wild.unionByName(fixed.select("host", "template", "segment", part.alias("part")))


def templates(counts: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(host, shape, template): the template of each path shape. `counts` has host, shape, segments, n, blocked, allowed."""
    rows = phase(counts.withColumn("template", F.lit("")), "urls-shapes")
    levels = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(levels):
        active = rows.filter(F.size("segments") > level)
        done = rows.filter(F.size("segments") <= level)
        parts = phase(_branches(active, level, tree), "urls-parts")
        wild = parts.filter("segment is null").select("host", "template", F.col("part").alias("wild"))
        fixed = parts.filter("segment is not null")
        found = active.withColumn("segment", F.col("segments")[level])
        found = found.join(_small(fixed), ["host", "template", "segment"], "left").join(_small(wild), ["host", "template"], "left")
        longer = found.withColumn("template", F.concat("template", F.lit("/"), F.coalesce("part", "wild"))).select(rows.columns)
        rows = phase(done.unionByName(longer), "urls-level")
    return rows


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES, tree: Tree = Tree()) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, blocked_share), one row per row of `pages`.

    A rule's verdict stands; any other url is blocked if its template is rejected. `blocked_share` is the template's
    smoothed share of blocked among labelled urls. Null urls and urls without `://` have an empty host and path; the empty
    host is a host like any other. Repeated urls count each time. Other columns play no part; an empty table has no rows.
    """
    name, verdict = fitting(rules)
    rows = located(pages.select("page_id", "url")).select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"))
    rows = rows.withColumn("segments", segments(F.col("path"), tree.depth)).withColumn("shape", F.array_join(F.transform("segments", lambda s: F.concat(F.lit("/"), s)), ""))
    blocked, allowed = (F.count_if(F.col("ruled").eqNullSafe(v)) for v in ("block", "allow"))
    counts = rows.groupBy("host", "shape").agg(F.first("segments").alias("segments"), F.count(F.lit(1)).alias("n"), blocked.alias("blocked"), allowed.alias("allowed"))
    found = templates(counts, tree)
    sums = found.groupBy("host", "template").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
    share = (F.col("blocked") + tree.weight / 2) / (F.col("blocked") + F.col("allowed") + tree.weight)
    scored = phase(sums.select("host", "template", share.alias("blocked_share")), "urls-scored")
    shapes = phase(found.select("host", "shape", "template").join(_small(scored), ["host", "template"]), "urls-judged")
    out = rows.select("page_id", "host", "path", "shape", "rule", "ruled").join(_small(shapes), ["host", "shape"], "left")
    method = F.when(F.col("blocked_share") >= tree.reject, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "blocked_share")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))
