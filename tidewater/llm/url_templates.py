"""URL filters by path-template trees (native).

Every URL is cut into host and path; rules (host, path prefix) that fit decide
and are the labels.  The other URLs are judged by the template of their path:

* digits in a segment become ``#``, and pages with one such path are one *cell*
  of their host, so the tree is built on cells instead of pages;
* level by level, per host and parent, a segment that few pages share is
  variable and becomes ``*``; the others are branches;
* sibling branches whose remaining paths look alike (same most frequent form)
  and whose labelled shares do not differ (two-proportion test) become one
  branch ``{a|b}``;
* the share of blocked labels of a template is smoothed by its parent's share
  and by the share of the same template over all hosts; a template is rejected
  if that share reaches ``REJECT``.

A branch holds at least ``BRANCH_PERCENT`` percent of its parent, so a parent
has at most 100 / BRANCH_PERCENT branches: the only windows here are over
those.  Everything else is grouped sums with partial aggregation.  The tree
has ``LEVELS`` levels; the last one holds all remaining segments as one, so
long paths are read whole.

Defined cases: a null URL or one without ``://`` has an empty host and path;
an empty path has the template ``$``; URLs given several times count once (by
host and path) and get the same verdict; without any label the smoothed share
is 0 and all is allowed; an empty table gives an empty result; other columns
are carried along.  A segment that spells a merged branch or wildcard is
treated as that.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    host: str
    path: str
    verdict: str


LEVELS = 4
#: A segment is a branch if at least this many URLs and this percentage of its parent's have it.
BRANCH_URLS, BRANCH_PERCENT = 3, 2
#: Labels that the prior of a template counts for; share of blocked labels from which a template is rejected.
PRIOR, REJECT = 4, 0.5
#: Chi-square of one degree of freedom at 5 percent.
DIFFERENT = 3.841
END, WILD = "$", "*"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL, whole."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits (block first among equally long ones), else null."""
    order = sorted(rules, key=lambda r: (-len(r.host + r.path), r.verdict != "block", r))
    out = F.lit(None).cast("string")
    for r in reversed(order):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.lit(value(r))).otherwise(out)
    return out


def segments(path: Column, levels: int = LEVELS) -> Column:
    """The segments of a path with digits generalised, ``END`` behind the last; at most ``levels``."""
    every = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/", -1), lambda x: x != "")
    every = F.concat(every, F.array(F.lit(END)))
    return F.when(F.size(every) <= levels, every).otherwise(F.concat(
        F.slice(every, 1, levels - 1), F.array(F.array_join(F.slice(every, levels, F.size(every)), "/"))))


def _share(blocked: str, labelled: str, prior: Column) -> Column:
    """Share of blocked labels, smoothed by ``prior``."""
    return (F.col(blocked) + PRIOR * prior) / (F.col(labelled) + PRIOR)


def _branches(cells: DataFrame, level: int, base: float) -> DataFrame:
    """(host, node, segment, label): the label of each segment below each node."""
    seg = F.get("segs", F.lit(level))
    form = F.array_join(F.transform(F.slice("segs", F.lit(level + 2), F.size("segs")), lambda x: F.when(
        x == END, END).when(F.contains(x, F.lit("#")), "#").otherwise("a")), "/")
    here = (cells.where(F.size("segs") > level)
            .groupBy("host", "node", seg.alias("segment"), form.alias("form"))
            .agg(F.sum("urls").alias("urls"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    segs = here.groupBy("host", "node", "segment").agg(F.sum("urls").alias("urls"))
    total = segs.groupBy("host", "node").agg(F.sum("urls").alias("total"))
    kept = attach(segs, total, "host", "node", how="inner").where(
        (F.col("urls") >= BRANCH_URLS) & (100 * F.col("urls") >= BRANCH_PERCENT * F.col("total"))
        & (F.col("segment") != END)).select("host", "node", "segment", F.col("segment").alias("branch"))
    known = attach(here, kept, "host", "node", "segment").withColumn(
        "branch", F.when(F.col("segment") == END, END).otherwise(F.coalesce("branch", F.lit(WILD))))

    # branches of a node: most frequent form of the rest, labels; at most 100 / BRANCH_PERCENT + 2
    forms = known.groupBy("host", "node", "branch", "form").agg(
        *[F.sum(c).alias(c) for c in ("urls", "labelled", "blocked")])
    branch = forms.groupBy("host", "node", "branch").agg(
        F.min_by("form", F.struct(-F.col("urls"), "form")).alias("form"),
        F.sum("labelled").cast("double").alias("n"), F.sum("blocked").cast("double").alias("b"))
    order = Window.partitionBy("host", "node").orderBy("form", "unlabelled", "share", "branch")
    branch = branch.withColumns({"unlabelled": F.col("n") == 0, "share": _share("b", "n", F.lit(base))})
    last = lambda c: F.lag(c).over(order)
    d = last("b") * F.col("n") - F.col("b") * last("n")
    both, sums = last("b") + F.col("b"), last("n") + F.col("n")
    apart = d * d * sums > DIFFERENT * last("n") * F.col("n") * both * (sums - both)
    first = (last("branch").isNull() | (last("form") != F.col("form")) | (last("unlabelled") != F.col("unlabelled"))
             | apart | (F.col("branch") == END) | (last("branch") == END))
    branch = branch.withColumn("first", first.cast("int")).withColumn("group", F.sum("first").over(order))
    merged = branch.groupBy("host", "node", "group").agg(F.sort_array(F.collect_list("branch")).alias("members"))
    label = F.when(F.size("members") == 1, F.element_at("members", 1)).otherwise(
        F.concat(F.lit("{"), F.array_join("members", "|"), F.lit("}")))
    named = merged.select("host", "node", label.alias("label"), F.explode("members").alias("branch"))
    pairs = known.select("host", "node", "segment", "branch").distinct()
    return attach(pairs, named, "host", "node", "branch", how="inner").select("host", "node", "segment", "label")


def learn(urls: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(host, segs, template, share) of every cell of ``urls`` (host, path,
    blocked: true, false, or null where unlabelled)."""
    once = urls.groupBy("host", "path").agg(F.max("blocked").alias("blocked"))
    cells = materialize(
        once.select("host", segments(F.col("path"), levels).alias("segs"), "blocked").groupBy("host", "segs").agg(
            F.count("*").alias("urls"), F.count("blocked").alias("labelled"),
            F.count(F.when(F.col("blocked"), 1)).alias("blocked"))
        .withColumn("node", F.lit("")), "cells")
    sums = cells.agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"), F.max(F.size("segs")).alias("depth")).first()
    base = (sums.b / sums.n) if sums.n else 0.0
    # the share of a host starts from all hosts', that of a template over all hosts likewise
    host = cells.groupBy("host").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    cells = attach(cells, host.select("host", _share("b", "n", F.lit(base)).alias("share")), "host").withColumn(
        "pooled", F.lit(base))
    for level in range(sums.depth or 0):
        cells = materialize(cells, "cells") if level else cells
        names = _branches(cells, level, base)
        seg = F.get("segs", F.lit(level))
        cells = attach(cells.withColumn("segment", F.coalesce(seg, F.lit(""))), names, "host", "node", "segment")
        told = F.col("label").isNotNull()
        cells = materialize(cells.withColumns({
            "ended": ~told, "node": F.when(told, F.concat("node", F.lit("/"), "label")).otherwise(F.col("node"))})
            .drop("segment", "label"), "cells")
        # own labels of a host's template, and of the template over all hosts
        own = cells.where("not ended").groupBy("host", "node", "share", "pooled").agg(
            F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
        pool = own.groupBy("node", "pooled").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).select(
            "node", _share("b", "n", F.col("pooled")).alias("p"))
        own = attach(own, pool, "node", how="inner").select(
            "host", "node", _share("b", "n", (F.col("share") + F.col("p")) / 2).alias("s"), "p")
        cells = attach(cells, own, "host", "node")
        cells = cells.withColumns({c: F.when(F.col("ended"), F.col(c)).otherwise(F.col(x))
                                   for c, x in (("share", "s"), ("pooled", "p"))}).drop("s", "p", "ended")
    return materialize(cells.select("host", "segs", F.col("node").alias("template"), "share"), "templates")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", levels: int = LEVELS) -> DataFrame:
    """``pages`` with host, path, rule, template, share and verdict (allow or
    block); columns of those names are replaced."""
    host, path = parts(F.col(url))
    added = ("host", "path", "rule", "template", "share", "verdict")
    cut = pages.select(F.struct(*[pages[c] for c in pages.columns if c not in added]).alias("page"),
                       host.alias("host"), path.alias("path"))
    cut = cut.withColumns({
        "segs": segments(F.col("path"), levels),
        "rule": fitting(F.col("host"), F.col("path"), rules, lambda r: r.host + r.path),
        "ruled": fitting(F.col("host"), F.col("path"), rules, lambda r: r.verdict)})
    known = learn(cut.select("host", "path", (F.col("ruled") == "block").alias("blocked")), levels)
    verdict = F.coalesce("ruled", F.when(F.col("share") >= REJECT, "block").otherwise("allow"))
    return attach(cut, known, "host", "segs").select(
        "page.*", "host", "path", "rule", "template", "share", verdict.alias("verdict"))
