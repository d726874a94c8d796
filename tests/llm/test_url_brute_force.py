"""URL templates against a tree grown in plain Python, one node after the other."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from math import sqrt

import pytest

from loanloom.llm import url_templates

FORMS = ((r"[0-9]+", "<n>"), (r"[0-9]{4}-[0-9]{2}(-[0-9]{2})?", "<date>"), (r"[0-9a-fA-F-]{16,}", "<hex>"))


def form(segment: str) -> str | None:
    stem = re.sub(r"\.[A-Za-z]{1,5}$", "", segment)
    return next((name for pattern, name in FORMS if re.fullmatch(pattern, stem)), None)


def split_url(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def rule_of(host: str, path: str):
    fits = [r for r in url_templates.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def relabel(rows: list[dict]) -> dict[str, str]:
    """New names of the children of one node that have as many levels below them."""
    children = defaultdict(lambda: [0, 0, 0])
    for r in rows:
        for i, x in enumerate((r["n"], r["bad"], r["good"])):
            children[r["segment"]][i] += x
    if len(children) >= 20 and len(children) >= 0.5 * sum(c[0] for c in children.values()):
        return {s: "*" for s in children}
    out = {}
    for name, bad_side in (("{-}", True), ("{+}", False)):
        side = {s: c for s, c in children.items() if c[1] + c[2] >= 5 and (c[1] > c[2]) == bad_side}
        bad, labelled = sum(c[1] for c in side.values()), sum(c[1] + c[2] for c in side.values())
        share = (bad + 1) / (labelled + 2)
        for s, c in side.items():
            n = c[1] + c[2]
            if len(side) > 1 and abs(c[1] - n * share) / sqrt(n * share * (1 - share)) < 1.96:
                out[s] = name
    return out


def judge(pages: list[tuple], labels: dict[int, bool], max_depth: int) -> list[tuple]:
    read = [(i, *split_url(url)) for i, url in pages]
    paths: dict[tuple, dict] = {}
    for i, host, path in read:
        rule = rule_of(host, path)
        bad = labels.get(i, None if rule is None else rule.verdict == "block")
        row = paths.setdefault((host, path), {"n": 0, "bad": 0, "good": 0, "template": ""})
        row["n"] += 1
        row["bad"] += bad is True
        row["good"] += bad is False
    for level in range(1, max_depth):
        groups = defaultdict(list)
        for (host, path), row in paths.items():
            parts = path.split("/")
            row["segment"] = parts[level] if level < len(parts) else None
            row["node"] = row["template"]
            if row["segment"] is not None and form(row["segment"]) is None:
                groups[host, row["node"], len(parts) - level].append(row)
        named = {key: relabel(rows) for key, rows in groups.items()}
        for (host, path), row in paths.items():
            if row["segment"] is not None:
                key = (host, row["node"], len(path.split("/")) - level)
                label = form(row["segment"]) or named[key].get(row["segment"], row["segment"])
                row["template"] = f"{row['node']}/{label}"
    for (_, path), row in paths.items():
        if len(path.split("/")) > max_depth:
            row["template"] += "/**"
    bad, good = (sum(r[c] for r in paths.values()) for c in ("bad", "good"))
    prior, pools = min(bad / max(1, bad + good), 0.5), defaultdict(lambda: [0, 0])
    for (host, _), row in paths.items():
        pools[host, row["template"]][0] += row["bad"]
        pools[host, row["template"]][1] += row["good"]
    out = []
    for i, host, path in read:
        rule, template = rule_of(host, path), paths[host, path]["template"]
        b, g = pools[host, template]
        verdict = "block" if (b + 2 * prior) / (b + g + 2) > 0.5 else "allow"
        out.append((i, host, path, rule and rule.name, template, rule.verdict if rule else verdict))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_equal_a_tree_grown_in_python(spark, seed):
    draw = random.Random(seed)
    hosts = ["s.org", "s.org", "s.org", "T.org", "b.net", "a.example.com", "www.example.com", "x.com"]
    first = ["ads", "casino", "news", "blog", "en", "es", "fr", "2024-01-05", "0123456789abcdef01.html"]
    pages = []
    for i in range(900):
        depth = draw.choice((0, 1, 2, 2, 3, 3, 7))
        below = [draw.choice((f"item{draw.randrange(400)}", "view", str(draw.randrange(50)))) for _ in range(depth - 1)]
        parts = [draw.choice(first), *below] if depth else []
        pages.append((i, f"http://{draw.choice(hosts)}{''.join('/' + p for p in parts)}{draw.choice(('', '/', '?q=/z', '#a'))}"))
    pages += [(900, None), (901, ""), (902, "no scheme/x"), (903, "x://"), (3, pages[3][1])]
    spam = ("ads", "casino", "es")
    labels = {i: draw.random() < (0.95 if any(f"/{s}" in (u or "") for s in spam) else 0.1) for i, u in pages if draw.random() < 0.6}
    df = spark.createDataFrame(pages, "page_id long, url string")
    given = spark.createDataFrame(list(labels.items()), "page_id long, blocked boolean")
    judged = url_templates.judge_urls(df, labels=given, max_depth=6)
    got = judged.select("page_id", "host", "path", "rule", "template", "verdict").collect()
    want = judge(pages, labels, 6)
    assert sorted(map(tuple, got), key=repr) == want
    seen = {t for *_, t, _ in want}
    assert any("{-}" in t for t in seen) and any("*" in t for t in seen) and any(t.endswith("/**") for t in seen)
    assert {v for *_, rule, _, v in want if rule is None} == {"allow", "block"}


def test_registered_parameters_equal_the_tree_without_labels(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    got = url_templates.judge_urls(pages).select("page_id", "host", "path", "rule", "template", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == judge([tuple(r) for r in pages.collect()], {}, 8)
