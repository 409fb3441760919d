"""Operator 4: url filters by a path-template tree.

Explicit rules come first: a rule names a host and a path start, fits that
host and all its subdomains, and the longest fitting rule decides.  Urls that
no rule fits are judged by their host's template tree:

1. Runs of digits, long hexadecimal runs and over-long segments are replaced
   by their shape, and equal (host, shaped path) pairs are counted once, with
   the number of labelled and of bad pages among them.  The tree is built on
   these counts, so a host that holds a third of all pages costs no more than
   its number of distinct shapes.
2. Level by level, a node with ``min_support`` pages or more (and every host)
   is opened.  Its segments with fewer pages than that, or too few labels to
   place their bad rate within ``width``, are variable and generalise into the
   wildcard ``*``.  The others are ordered by the arcsine of their bad rate,
   whose standard error depends on the number of labels only, and neighbours
   that a two-sample test of ``z`` standard errors does not tell apart merge,
   as far as the merged rates span less than ``width``; the branch is called
   ``*`` and its first segment (a segment that itself begins with ``*`` gets a
   backslash).  The steps end when no node has support; paths of any depth
   are followed that far, and what lies below belongs to the last node.
3. A template's purity is its share of good labelled pages, smoothed by
   ``weight`` pages towards its host's, and that towards the whole table's.
   Templates of a purity below ``min_purity`` are blocked.

Everything is DataFrame operations; counts aggregate before they shuffle.

Defined cases: a null url, or one without ``://``, has empty host and path
and is judged as that host's root; without labels every purity is 1 and the
method allows; null or other labels than 0 and 1 do not count; repeated rows
are judged alike; equal rates are ordered by segment; urls of any length are
read whole; an empty table gives an empty result; the input row stays in the
struct ``page``, so extra columns clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirpwave.session import ensure_checkpoint_dir

#: (host, path start, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null."""
    ordered = sorted(rules, key=lambda r: len(r[0] + r[1]), reverse=True)
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in ordered]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def shape_of(path: Column) -> Column:
    """The path with its evidently variable parts generalised."""
    shaped = F.regexp_replace(path, r"[0-9a-fA-F]{12,}", "~")
    return F.regexp_replace(F.regexp_replace(shaped, r"[0-9]+", "#"), r"[^/]{40,}", "@")


def _branches(child: DataFrame, min_support: int, z: float, width: float) -> DataFrame:
    """``(host, template, part, branch)`` from the counts of the segments below each node."""
    keys = ["host", "template"]
    known = (F.col("n") >= min_support) & (F.col("labelled") >= (z / (2 * width)) ** 2)
    rate = child.where(known).withColumn("rate", F.asin(F.sqrt(F.col("bad") / F.col("labelled"))))
    order = Window.partitionBy(*keys).orderBy("rate", "part")
    error = F.sqrt(1 / (4 * F.col("labelled")) + 1 / (4 * F.lag("labelled").over(order)))
    apart = F.col("rate") - F.lag("rate").over(order) > z * error
    chained = rate.withColumn("chain", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order))
    low = F.min("rate").over(Window.partitionBy(*keys, "chain"))
    chained = chained.withColumn("band", F.floor((F.col("rate") - low) / width))
    alike = Window.partitionBy(*keys, "chain", "band")
    named = F.when(F.col("part").startswith("*"), F.concat(F.lit("\\"), "part")).otherwise(F.col("part"))
    branch = F.when(F.count(F.lit(1)).over(alike) == 1, named).otherwise(F.concat(F.lit("*"), F.min("part").over(alike)))
    return (chained.select(*keys, "part", branch.alias("branch"))
            .unionByName(child.where(~known).select(*keys, "part", F.lit("*").alias("branch"))))


def templates(shapes: DataFrame, min_support: int, z: float, width: float) -> DataFrame:
    """Adds ``template`` to ``(host, shape, n, labelled, bad)`` rows.  Each
    level is written once and read by the next."""
    tree = (shapes.withColumn("parts", F.split("shape", "/")).withColumn("template", F.lit(""))
            .withColumn("open", F.lit(True)).checkpoint())
    level = 1
    while True:
        deeper = F.col("open") & (F.size("parts") > level)
        if tree.where(deeper).isEmpty():
            return tree.select("host", "shape", "n", "labelled", "bad", "template")
        step = tree.withColumn("part", F.when(deeper, F.get("parts", F.lit(level))))
        child = step.where("part is not null").groupBy("host", "template", "part").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        branch = _branches(child, min_support, z, width)
        support = (child.join(branch, ["host", "template", "part"]).groupBy("host", "template", "branch")
                   .agg((F.sum("n") >= min_support).alias("goes_on")))
        branch = branch.join(support, ["host", "template", "branch"])
        tree = (step.join(branch, ["host", "template", "part"], "left")
                .withColumn("template", F.when(F.col("branch").isNotNull(), F.concat("template", F.lit("/"), "branch"))
                            .otherwise(F.col("template")))
                .withColumn("open", F.coalesce("goes_on", F.lit(False))).drop("part", "branch", "goes_on").checkpoint())
        level += 1


def url_filter(pages: DataFrame, label: Column | None = None, url_col: str = "url", rules=RULES,
               min_support: int = 20, z: float = 1.96, width: float = 0.2, weight: float = 10.0, min_purity: float = 0.7) -> DataFrame:
    """One row per input row: ``page`` (the input row), ``host``, ``path``,
    ``rule``, ``template``, ``purity`` and ``verdict``.  ``label`` is a column
    of ``pages``: 1 for a page known as bad, 0 for good, null for unknown."""
    label = F.lit(None).cast("int") if label is None else label.cast("int")
    url = F.col(url_col)
    rows = pages.select(F.struct("*").alias("page"), host_of(url).alias("host"), path_of(url).alias("path"),
                        F.when(label.isin(0, 1), label).alias("label"))
    rows = rows.withColumn("shape", shape_of(F.col("path"))).withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    shapes = rows.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"),
                                              F.coalesce(F.sum("label"), F.lit(0)).alias("bad"))
    ensure_checkpoint_dir(pages.sparkSession)
    tree = templates(shapes, min_support, z, width)
    node = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    hosts = node.groupBy("host").agg(F.sum("labelled").alias("h_labelled"), F.sum("bad").alias("h_bad"))
    whole = hosts.agg(F.sum("h_labelled").alias("a_labelled"), F.sum("h_bad").alias("a_bad"))  # one row
    overall = F.when(F.col("a_labelled") > 0, 1 - F.col("a_bad") / F.col("a_labelled")).otherwise(F.lit(1.0))

    def smoothed(labelled, bad, towards):
        return (labelled - bad + weight * towards) / (labelled + weight)

    judged = (node.join(hosts.crossJoin(F.broadcast(whole)), "host")
              .withColumn("h_purity", smoothed(F.col("h_labelled"), F.col("h_bad"), overall))
              .select("host", "template", smoothed(F.col("labelled"), F.col("bad"), F.col("h_purity")).alias("purity")))
    verdicts = tree.select("host", "shape", "template").join(judged, ["host", "template"])
    method = F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow"))
    return (rows.join(verdicts, ["host", "shape"])
            .select("page", "host", "path", F.col("fit.rule").alias("rule"), "template", "purity",
                    F.coalesce(F.col("fit.verdict"), method).alias("verdict")))
