"""URL filter: a tree of path templates for each host, judged by labelled purity.

Level by level, the segments under one template of a host are generalised: those
that vary by nature, or without labels enough to tell them apart, become ``*``,
and labelled siblings whose shares do not differ significantly are merged
into ``#``.  A template is rejected when its smoothed share of bad labels is high.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.sources.scratch import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Segments with a digit, or as long as only keys are, are variable by nature.
_VARIABLE = r"[0-9]|^.{40,}$"


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The struct ``(text, verdict)`` of the longest rule that fits, or null.  Rules are few: a setting."""
    fitting = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(len(r.text)).alias("length"), F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fitting)) if fitting else F.lit(None).cast("struct<length:int,text:string,verdict:string>")


def templates(
    urls: DataFrame, *, z: float = 1.96, least_labelled: int = 5, max_depth: int = 12
) -> DataFrame:
    """``urls(..., host, path, bad)`` with ``template``; ``bad`` is 0, 1 or null where unlabelled.

    A segment becomes ``*`` if it has a digit or 40 characters.  Of several
    segments, one with ``least_labelled`` labels or more becomes ``#`` if its
    siblings have as many and its share of bad labels is within ``z`` standard
    errors of theirs, and stays apart otherwise.  One with fewer labels shares no
    template with those: it becomes ``*`` (``?`` where ``*`` has
    ``least_labelled`` labels by itself), so such segments are judged together,
    by what labels they have; a segment without siblings keeps its name, which
    changes no verdict.  Neither ``#`` nor ``?`` can be
    in a path.  From ``max_depth`` on the rest of a path is one segment.  Each
    level is a grouping with partial sums and an equi-join on host, template and
    segment.
    """
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    tail = F.array_join(F.slice(parts, max_depth, F.greatest(F.size(parts), F.lit(1))), "/")
    rows = urls.withColumn(
        "_parts", F.when(F.size(parts) > max_depth, F.concat(F.slice(parts, 1, max_depth - 1), F.array(tail))).otherwise(parts)
    )
    rows = materialize(rows.withColumn("template", F.lit("")), "level")
    depth = rows.agg(F.max(F.size("_parts"))).first()[0] or 0
    for level in range(depth):
        segment = F.get("_parts", F.lit(level))
        rows = rows.withColumn("_segment", F.when(F.regexp_like(segment, F.lit(_VARIABLE)), "*").otherwise(segment))
        merged = materialize(_merged(rows.filter("_segment IS NOT NULL"), z, least_labelled), "merged")
        joined = rows.join(merged, ["host", "template", "_segment"], "left")
        token = F.coalesce("_token", "_segment")
        rows = materialize(
            joined.withColumn("template", F.concat("template", F.coalesce(F.concat(F.lit("/"), token), F.lit("")))).drop("_segment", "_token"),
            "level",
        )
    return rows.drop("_parts")


def _merged(rows: DataFrame, z: float, least_labelled: int) -> DataFrame:
    """``host, template, _segment, _token`` of every segment under every template."""
    children = materialize(
        rows.groupBy("host", "template", "_segment").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")),
        "children",
    )
    parents = materialize(
        children.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("children"),
            F.sum("n").alias("all_n"),
            F.sum("b").alias("all_b"),
            F.max(F.when(F.col("_segment") == "*", F.col("n"))).alias("variable_n"),
        ),
        "parents",
    )
    rest_n, rest_b = F.col("all_n") - F.col("n"), F.col("all_b") - F.col("b")
    pooled = F.try_divide("all_b", "all_n")
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "n") + F.try_divide(F.lit(1), rest_n)))
    alike = F.abs(F.try_divide("b", "n") - F.try_divide(rest_b, rest_n)) <= z * error
    labelled = F.col("n") >= least_labelled
    sparse = F.when(F.coalesce("variable_n", F.lit(0)) >= least_labelled, "?").otherwise("*")
    token = (
        F.when(labelled & (rest_n >= least_labelled) & alike, "#")
        .when(~labelled & (F.col("children") > 1) & (F.col("_segment") != "*"), sparse)
        .otherwise(F.col("_segment"))
    )
    return children.join(parents, ["host", "template"]).select("host", "template", "_segment", token.alias("_token"))


def judged(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[Rule],
    *,
    threshold: float = 0.5,
    weight: float = 4.0,
    **settings,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity``, one row per row of ``pages``.

    ``labels(page_id, bad)`` covers some pages; several labels of one page count
    as its worst.  ``purity`` is the share of bad labels of a host's template,
    smoothed by ``weight`` labels of the overall share; at ``threshold`` or more
    the template is rejected and its pages get ``block``, else ``allow``.  The
    longest rule that fits overrides that.  A null url, or one without ``://``,
    has an empty host and path.  Without labels everything is allowed.
    """
    worst = labels.filter("page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = templates(urls.join(materialize(worst, "labels"), "page_id", "left"), **settings)
    overall = rows.agg(F.avg("bad")).first()[0] or 0.0
    purity = (F.coalesce(F.sum("bad"), F.lit(0)) + weight * overall) / (F.count("bad") + weight)
    stats = materialize(rows.groupBy("host", "template").agg(purity.alias("purity")), "purity")
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("purity") >= threshold, "block").otherwise("allow")
    return (
        rows.join(stats, ["host", "template"])
        .withColumn("_rule", rule)
        .select("page_id", "host", "path", F.col("_rule.text").alias("rule"), F.coalesce("_rule.verdict", own).alias("verdict"), "template", "purity")
    )
