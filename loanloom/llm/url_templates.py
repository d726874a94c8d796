"""URL filters: host rules first, then per-host path templates judged by their labelled pages."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shared import materialise
from .common import ascii_lower


class HostRule(NamedTuple):
    """Applies to a host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


# The production rules.
RULES = (
    HostRule("com", "/", "allow"),
    HostRule("example.com", "/en/", "block"),
    HostRule("www.example.com", "/en/", "allow"),
    HostRule("net", "/es/", "block"),
    HostRule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: HostRule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")
    return host & F.col("path").startswith(rule.path)


def apply_rules(pages: DataFrame, rules: tuple[HostRule, ...]) -> DataFrame:
    """Adds ``rule`` and ``ruled``, its verdict: those of the longest rule that fits, or null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        name = F.when(_fits(rule), rule.name).otherwise(name)
        verdict = F.when(_fits(rule), rule.verdict).otherwise(verdict)
    return pages.withColumn("rule", name).withColumn("ruled", verdict)


def _shape(segment: Column) -> Column:
    """What kind of thing a segment is, where its form alone shows that it varies; else null."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return (
        F.when(stem.rlike(r"^[0-9]+$"), "<n>")
        .when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), "<date>")
        .when(stem.rlike(r"^[0-9a-fA-F-]{16,}$"), "<hex>")
    )


def path_templates(
    paths: DataFrame,
    max_depth: int = 8,
    min_children: int = 20,
    min_spread: float = 0.5,
    similar_z: float = 1.96,
    min_labelled: int = 5,
) -> DataFrame:
    """``host, path, template`` of every row of ``paths`` (``host, path, n, n_block, n_allow``, one per path).

    The tree grows level by level from the host. A segment whose form shows a number, date or long code becomes a
    wildcard of that form; under a node with ``min_children`` children or more, of which each has few pages
    (distinct children over pages at least ``min_spread``), all children become ``*``. Literal branches of one
    node that lead to paths of the same length, have ``min_labelled`` labels each, lean to the same side and whose
    share of blocked pages does not differ from that of all such branches together (|z| < ``similar_z``) are
    merged into ``{-}`` (mostly blocked) or ``{+}``.
    Segments beyond ``max_depth`` levels are folded into ``**``: no path is dropped.

    Each level counts children (host, node, segment) with partial sums and then nodes over those counts, so a
    host that holds a third of all pages is summed in every task before it is shuffled.
    """
    split = F.split(F.col("path"), "/")
    nodes = paths.withColumn("parts", split).withColumn("depth", F.size("parts"))
    nodes = nodes.withColumn("template", F.lit(""))
    deepest = min(max_depth, nodes.agg(F.max("depth")).first()[0] or 0)
    for level in range(1, deepest):  # parts[0] is what stands before the first slash: nothing
        here = nodes.withColumn("segment", F.get("parts", F.lit(level)))
        here = here.withColumn("form", _shape(F.col("segment"))).withColumn("node", F.col("template"))
        here = here.withColumn("rest", F.col("depth") - level)
        children = materialise(
            here.filter(F.col("segment").isNotNull() & F.col("form").isNull())
            .groupBy("host", "node", "rest", "segment")
            .agg(*[F.sum(c).alias(c) for c in ("n", "n_block", "n_allow")])
        )
        n = F.col("n_block") + F.col("n_allow")
        leans = {"{-}": (n >= min_labelled) & (2 * F.col("n_block") > n), "{+}": (n >= min_labelled) & (2 * F.col("n_block") <= n)}
        pools = [
            F.sum(F.when(lean, x).otherwise(0)).alias(f"{name}_{what}")
            for name, lean in leans.items()
            for what, x in (("block", F.col("n_block")), ("all", n), ("branches", F.lit(1)))
        ]
        parents = materialise(
            children.groupBy("host", "node", "rest").agg(F.count("*").alias("children"), F.sum("n").alias("pages"), *pools)
        )

        def alike(name: str) -> Column:
            pool = {what: F.col(f"`{name}_{what}`") for what in ("block", "all", "branches")}
            share = (pool["block"] + 1) / (pool["all"] + 2)
            z = F.abs(F.col("n_block") - n * share) / F.sqrt(n * share * (1 - share))
            return leans[name] & (pool["branches"] > 1) & (z < similar_z)

        wide = (F.col("children") >= min_children) & (F.col("children") >= min_spread * F.col("pages"))
        known = materialise(
            children.join(parents, ["host", "node", "rest"]).select(
                "host",
                "node",
                "rest",
                "segment",
                F.when(wide, "*")
                .when(alike("{-}"), "{-}")
                .when(alike("{+}"), "{+}")
                .otherwise(F.col("segment"))
                .alias("label"),
            )
        )
        step = F.when(F.col("segment").isNull(), "").otherwise(
            F.concat(F.lit("/"), F.coalesce("form", "label", "segment"))
        )
        nodes = here.join(known, ["host", "node", "rest", "segment"], "left").select(
            "host", "path", "n", "n_block", "n_allow", "parts", "depth", F.concat("template", step).alias("template")
        )
    folded = F.when(F.col("depth") > max_depth, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return nodes.select("host", "path", "n", "n_block", "n_allow", folded.alias("template"))


def judge_urls(
    pages: DataFrame,
    rules: tuple[HostRule, ...] = RULES,
    labels: DataFrame | None = None,
    threshold: float = 0.5,
    prior_weight: float = 2.0,
    **tree: float,
) -> DataFrame:
    """``page_id, host, path, rule, template, purity, verdict`` of every row of ``pages`` (``page_id, url``).

    A rule decides the pages that it fits. All others get the verdict of their path template: blocked if its
    smoothed share of blocked labelled pages, (blocked + w * prior) / (labelled + w) with the share over all
    labelled pages as the prior (held below ``threshold``), exceeds ``threshold``. Labelled pages are those that a
    rule decides and those in ``labels`` (``page_id, blocked``), which override the rule as a label; of several
    labels of a page the majority counts, even ones allow it, null ones say nothing. A template without labels is allowed. A null url, or one without ``://``, has an empty host and path
    and so a template of its own; repeated rows are judged alike; an empty table gives an empty result.
    """
    read = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = apply_rules(read, rules)
    blocked = F.col("ruled") == "block"
    if labels is not None:
        marks = F.col("blocked").cast("boolean")
        given = labels.groupBy("page_id").agg(
            F.when(F.count(marks) > 0, 2 * F.count_if(marks) > F.count(marks)).alias("given")
        )
        ruled = ruled.join(given, "page_id", "left")
        blocked = F.coalesce("given", blocked)
    paths = materialise(
        ruled.groupBy("host", "path").agg(
            F.count("*").alias("n"),
            F.count(F.when(blocked, 1)).alias("n_block"),
            F.count(F.when(~blocked, 1)).alias("n_allow"),
        )
    )
    templates = materialise(path_templates(paths, **tree))
    counts = templates.agg(F.sum("n_block"), F.sum(F.col("n_block") + F.col("n_allow"))).first()
    prior = min((counts[0] or 0) / max(1, counts[1] or 0), threshold)
    purity = (F.sum("n_block") + prior_weight * prior) / (F.sum("n_block") + F.sum("n_allow") + prior_weight)
    judged = materialise(templates.groupBy("host", "template").agg(purity.alias("purity")))
    by_path = templates.join(judged, ["host", "template"]).select("host", "path", "template", "purity")
    return ruled.join(by_path, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        "rule",
        "template",
        "purity",
        F.coalesce("ruled", F.when(F.col("purity") > threshold, "block").otherwise("allow")).alias("verdict"),
    )
