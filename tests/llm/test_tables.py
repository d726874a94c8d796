"""Mixing, sharding, URL templates and the pipeline."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loanloom.llm import mixing, sharding, url_templates
from loanloom.llm.queries import MIX
from .helpers import awkward_rows, clashing, prose, rows_of, table_of

LABELS = "doc_id long, quality int, toxic int"


def labelled(n: int) -> tuple[list[tuple], list[tuple]]:
    draw = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        kind = ("high", "high", "low", "toxic")[i % 4]
        text = prose(draw.randint(40, 120), 1000 + i)
        if kind == "low":
            text = text.upper() + " !!" * 40
        if kind == "toxic":
            text += " you scum idiot"
        docs.append((i, text, "en", "a", len(text)))
        labels.append((i, int(kind != "low"), int(kind == "toxic")))
    return docs, labels


def test_mixing_meets_its_targets_and_tells_domains_apart(spark):
    docs, labels = labelled(400)
    weights = {"high": 0.6, "low": 0.4, "toxic": 0.0}
    known = spark.createDataFrame(labels[:200] + [(None, 1, 0), (5, None, None), (9999, 1, 0), labels[0]], LABELS)
    mixed = mixing.mixed_rates(table_of(spark, docs), mixing.label_domains(known), weights).collect()
    right = sum(r["mix"]["domain"] == ("high", "high", "low", "toxic")[r["doc_id"] % 4] for r in mixed if r["doc_id"] >= 200)
    assert right >= 0.95 * 200  # held out
    expected = defaultdict(float)
    for r in mixed:
        m = r["mix"]
        assert 0 <= m["rate"] <= 4 and abs(sum(m["posterior"].values()) - 1) < 1e-9
        assert m["copies"] >= (1 if m["domain"] != "toxic" else 0)
        for d, p in m["posterior"].items():
            expected[d] += m["rate"] * m["tokens"] * p
    total = sum(expected.values())
    assert all(abs(expected[d] / total - weights[d]) < 0.01 for d in weights), dict(expected)


def test_rates_reach_given_totals(spark):
    read = spark.createDataFrame([([0.9, 0.1], 100), ([0.2, 0.8], 300), ([0.5, 0.5], 50)], "posterior array<double>, tokens long")
    fit = mixing.fit_mix(read, ("a", "b"), {"a": 0.5, "b": 0.5}, total=600.0)
    assert all(abs(r - 300) < 0.1 for r in fit.reached)
    assert mixing.fit_mix(read.limit(0), ("a", "b"), {"a": 1.0}).steps == ()


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The active-set method: variables enter by their gradient and leave where they would turn negative."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    while True:
        gradient = a.T @ (b - a @ x)
        gradient[free] = -np.inf
        if free.all() or gradient.max() <= 1e-12 * np.abs(a.T @ b).max():
            return x
        free[gradient.argmax()] = True
        while True:
            z = np.zeros_like(x)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if (z[free] > 1e-14).all():
                x = z
                break
            low = free & (z <= 1e-14)
            x = x + min(x[low] / (x[low] - z[low])) * (z - x)
            free &= x > 1e-14


def mixing_case(draw: random.Random) -> tuple[list[list[float]], list[int], list[float], float]:
    """Posteriors, tokens, wanted shares and total; some domains are rare, some wanted beyond reach."""
    k, n = draw.choice((2, 3)), draw.randint(2, 9)
    sharp, rare = draw.choice((0.3, 1, 3)), [1.0, 1.0, draw.choice((0.01, 0.2, 1))]
    raw = [[rare[d] * draw.random() ** sharp + 1e-3 for d in range(k)] for _ in range(n)]
    share = [draw.random() if draw.random() < 0.8 else 0.0 for _ in range(k)]
    share[0] += 0.01
    return [[x / sum(r) for x in r] for r in raw], [draw.randint(1, 400) for _ in range(n)], [x / sum(share) for x in share], draw.choice((200.0, 1000.0, 5000.0))


def test_steps_lead_to_nonnegative_least_squares():
    draw, unmet = random.Random(8), 0
    for _ in range(200):
        posterior, tokens, share, total = mixing_case(draw)
        p, t, target = np.array(posterior), np.array(tokens, float), np.array(share) * total

        def sums(steps, nu):
            rate = np.ones(len(t))
            for step in (*steps, nu):
                rate = np.maximum(0.0, rate - p @ np.array(step))
            on = rate > 0
            return (t * rate**2).sum(), (t * rate) @ p, (p[on] * t[on, None]).T @ p[on]

        _, reached = mixing.descend(sums, target, t.sum())
        a = (p * t[:, None]).T
        best = a @ nonnegative_least_squares(a, target)
        unmet += np.abs(best - target).max() > 1e-3 * total
        off, least = np.square(reached - target).sum() ** 0.5, np.square(best - target).sum() ** 0.5
        assert off <= least + 2e-3 * total, (posterior, tokens, share, total, reached, best)
        assert np.abs(reached - best).max() <= 2e-2 * total
    assert unmet > 40


def test_a_target_beyond_reach_gives_the_nearest_mix(spark):
    draw = random.Random(9)
    for _ in range(4):
        posterior, tokens, share, total = mixing_case(draw)
        names = ("a", "b", "c")[: len(share)]
        read = spark.createDataFrame(list(zip(posterior, tokens)), "posterior array<double>, tokens long")
        fit = mixing.fit_mix(read, names, dict(zip(names, share)), total=total)
        a = (np.array(posterior) * np.array(tokens, float)[:, None]).T
        best = a @ nonnegative_least_squares(a, np.array(share) * total)
        assert np.abs(np.array(fit.reached) - best).max() <= 2e-2 * total
    # A domain of almost no tokens is wanted by most: no corpus of many times the wanted size comes out.
    rows = [([0.98, 0.0198, 0.0002], 100)] * 490 + [([0.5, 0.49, 0.01], 100)] * 10
    fit = mixing.fit_mix(spark.createDataFrame(rows, "posterior array<double>, tokens long"), ("a", "b", "c"), {"a": 0.05, "b": 0.05, "c": 0.9})
    assert sum(fit.reached) <= 1.5 * sum(fit.targets) and fit.reached[2] < 0.5 * fit.targets[2]


def test_equal_posteriors_get_equal_rates_and_ties_a_domain(spark):
    docs = table_of(spark, [(i, "", "en", "a", 0) for i in range(6)] + [(9, "green river stone", "en", "a", 1)])
    known = spark.createDataFrame([(0, "x"), (1, "y"), (2, "x"), (3, "y")], "doc_id long, domain string")
    rows = mixing.mixed_rates(docs, known, {"x": 0.5, "y": 0.5}).collect()
    empty = [r["mix"] for r in rows if r["doc_id"] < 9]
    assert len({(m["domain"], m["rate"], tuple(sorted(m["posterior"].items()))) for m in empty}) == 1


def test_rates_have_no_upper_bound_and_unmet_targets_show(spark, caplog):
    schema = "posterior array<double>, tokens long"
    rare = spark.createDataFrame([([0.97, 0.02, 0.01], 100)] * 95 + [([0.1, 0.88, 0.02], 100)] * 2 + [([0.2, 0.0, 0.8], 100)] * 3, schema)
    fit = mixing.fit_mix(rare, ("high", "low", "toxic"), MIX)
    assert all(abs(r - t) < 0.02 * sum(fit.targets) for r, t in zip(fit.reached, fit.targets)), fit
    assert abs(fit.reached[1] - fit.targets[1]) < 1e-3 * sum(fit.targets)
    assert rare.select(F.max(mixing._rate(F.col("posterior"), fit.steps))).first()[0] > 4
    assert "toxic" in caplog.text  # no document is quite free of it
    # Posteriors that hardly tell the domains apart converge all the same.
    flat = spark.createDataFrame([([0.5 + x / 1000, 0.5 - x / 1000], 100) for x in range(-50, 51)], schema)
    fit = mixing.fit_mix(flat, ("a", "b"), {"a": 0.54, "b": 0.46}, total=10_100.0)
    assert all(abs(r - t) < 2e-3 * sum(fit.targets) for r, t in zip(fit.reached, fit.targets)), fit


def test_every_word_that_passes_the_thresholds_counts(spark):
    draw = random.Random(3)
    own = {d: ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(200)] for d in ("high", "toxic")}
    docs, labels = [], []
    for i in range(600):
        d = ("high", "toxic")[i % 2]
        docs.append((i, " ".join(draw.sample(own[d], 30) + [f"w{draw.randint(0, 9)}"] * 30), "en", "a", 1))
        labels.append((i, d))
    docs += [(1000 + k, w, "en", "a", 1) for k, w in enumerate(own["toxic"])]
    table, known = table_of(spark, docs), spark.createDataFrame(labels, "doc_id long, domain string")
    model = mixing.fit_classifier(table, known)
    assert {*own["high"], *own["toxic"]} <= {*model.words}
    mixed = mixing.mixed_rates(table, known, {"high": 1.0}).filter("doc_id >= 1000")
    plain = mixing.mixed_rates(table_of(spark, [*docs, (2000, "unknown", "en", "a", 1)]), known, {"high": 1.0}).filter("doc_id = 2000")
    least = plain.first()["mix"]["posterior"]["toxic"]
    assert all(r["mix"]["posterior"]["toxic"] > least for r in mixed.collect())
    # The look-up equals the sum over the words that a text has.
    text = " ".join(own["toxic"][:3] + own["high"][:2])
    row = spark.createDataFrame([(text.split(),)], "words array<string>")
    got = row.select(mixing._log_odds(F.col("words"), model)).first()[0]
    at = [model.words.index(w) for w in text.split()]
    assert got == pytest.approx([p + sum(w[i] for i in at) for p, w in zip(model.priors, model.weights)])


def test_mixing_of_awkward_rows(spark):
    docs = clashing(table_of(spark, awkward_rows()))
    none = mixing.mixed_rates(docs, spark.createDataFrame([], "doc_id long, domain string"), MIX)
    assert none.count() == len(awkward_rows()) and {r["mix"]["rate"] for r in none.collect()} == {1.0}
    labels = mixing.label_domains(spark.createDataFrame([(3, 1, 0), (7, 0, 1), (None, None, None)], LABELS))
    out = mixing.repeated(docs, labels, MIX)
    assert out.columns == docs.columns and out.count() > 0
    assert mixing.repeated(docs.limit(0), labels, MIX).count() == 0


def test_shards_fit_and_split_only_where_needed(spark):
    rows = awkward_rows() + [(20, "y" * 50, "en", "a", 1)] * 200 + [(1000 + i, "z" * 40, "en", "a", 1) for i in range(100)]
    shards = sharding.assign_shards(clashing(table_of(spark, rows)), 1000).collect()
    assert len(shards) == len(rows)
    by_shard = defaultdict(list)
    for r in shards:
        assert len(r["shard"]) == r["depth"]
        by_shard[r["shard"]].append(r)
    for name, own in by_shard.items():
        assert sum(r["n_bytes"] for r in own) == own[0]["shard_bytes"] and len(own) == own[0]["shard_rows"]
        assert (own[0]["shard_bytes"] <= 1000) != own[0]["over_limit"] and (not own[0]["over_limit"] or len(own) == 1)
        assert not any(other != name and other.startswith(name) for other in by_shard)
    assert sharding.assign_shards(table_of(spark, []), 1000).count() == 0


def test_directory_and_written_shards(spark, tmp_path):
    rows = [(i, "z" * (10 + i), "en", "a", 1) for i in range(64)]
    shards = sharding.assign_shards(table_of(spark, rows), 500)
    entries = {r["entry"]: r["shard"] for r in sharding.directory(shards).collect()}
    deepest = max(map(len, entries))
    assert len(entries) == 2**deepest and all(e.startswith(s) for e, s in entries.items())
    sharding.write_shards(table_of(spark, rows), str(tmp_path / "out"), 500)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 64
    assert back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).agg(F.max("n")).first()[0] <= 500


def test_no_two_sibling_shards_fit_together(spark):
    rows = [(i, "h" * 10_000, "en", "a", 1) for i in range(4)] + [(10 + i, "s" * 5, "en", "a", 1) for i in range(400)]
    shards = {r["shard"]: r for r in sharding.assign_shards(table_of(spark, rows), 2_000).collect()}
    for name, r in shards.items():
        other = shards.get(name[:-1] + "10"[int(name[-1])])
        assert other is None or r["shard_bytes"] + other["shard_bytes"] > 2_000
    assert sum(r["over_limit"] for r in shards.values()) == 4
    one = sharding.assign_shards(table_of(spark, rows), 1 << 30).select("shard", "depth").distinct().collect()
    assert [tuple(r) for r in one] == [("", 0)]


def test_written_shards_keep_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "n" * 40, "en", "a", 1), (5, "r" * 30, "en", "a", 2), (5, "r" * 30, "en", "a", 2), (6, None, None, None, None)]
    sharding.write_shards(clashing(table_of(spark, rows)), str(tmp_path / "out"), 60)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back.select(*table_of(spark, rows).columns)) == sorted(rows, key=repr)


@pytest.mark.parametrize(
    "url,host,path,rule,verdict",
    [
        ("http://A.Example.com/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://x.www.example.com/en/1", "x.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://b.net/es/2", "b.net", "/es/2", "net/es/", "block"),
        ("http://b.net/es", "b.net", "/es", None, "allow"),
        ("http://notexample.com/en/2", "notexample.com", "/en/2", "com/", "allow"),
        ("http://com?q=/", "com", "", None, "allow"),
        ("//no.scheme/x", "", "", None, "allow"),
        ("a?b://C.D/e", "c.d", "/e", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_rules_decide(spark, url, host, path, rule, verdict):
    got = url_templates.judge_urls(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert (got["host"], got["path"], got["rule"], got["verdict"]) == (host, path, rule, verdict)


def test_templates_generalise_and_reject(spark):
    pages = [(i, f"http://s.org/shop/item{i}x/view") for i in range(40)]  # variable by spread
    pages += [(100 + i, f"http://s.org/news/{2000 + i}") for i in range(40)]  # variable by form
    pages += [(200 + i, f"http://s.org/{('red', 'blue')[i % 2]}/{i}") for i in range(40)]  # alike branches
    pages += [(300, None), (300, None)]
    labels = [(i, True) for i in range(20)] + [(100 + i, False) for i in range(20)] + [(200 + i, True) for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    judged = url_templates.judge_urls(df, labels=spark.createDataFrame(labels, "page_id long, blocked boolean"))
    got = {r["page_id"]: r for r in judged.collect()}
    assert judged.count() == len(pages)
    assert got[30]["template"] == "/shop/*/view" and got[30]["verdict"] == "block"
    assert got[130]["template"] == "/news/<n>" and got[130]["verdict"] == "allow"
    assert got[235]["template"] == "/{-}/<n>" and got[235]["verdict"] == "block"
    deep = spark.createDataFrame([(1, "http://h.org" + "/a" * 40)], "page_id long, url string")
    assert url_templates.judge_urls(deep).first()["template"] == "/a" * 7 + "/**"
    assert url_templates.judge_urls(df.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs, labels = labelled(300)
    docs += [(1000 + i, docs[0][1], "en", "a", 1) for i in range(5)] + [(2000, "too short", "en", "a", 1)]
    docs += [(2001, prose(80, 77) + " mail me@site.org now", "en", "a", 1), (2002, None, None, None, None)]
    table_of(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    read, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = read.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        read = stage(spark, read, str(tmp_path))
        read.write.parquet(f"{tmp_path}/stage{k}")
        read = spark.read.parquet(f"{tmp_path}/stage{k}")
        kept.append({r["doc_id"] for r in read.select("doc_id").collect()})
        assert k == len(corpus_pipeline.STAGES) - 1 or read.columns == columns
    assert 2000 not in kept[0] and 2002 not in kept[0] and 1000 in kept[0]
    assert 0 in kept[1] and not kept[1] & set(range(1000, 1005))
    masked = spark.read.parquet(f"{tmp_path}/stage2").filter("doc_id = 2001").first()
    assert "<email>" in masked["text"] and masked["n_chars"] == len(masked["text"])
    clean = {i for i in kept[2] if i < 300 and i % 4 < 2}
    assert clean <= kept[3] and not {i for i in kept[3] if i < 300 and i % 4 == 3}
    assert kept[4] == kept[3]
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in again.select("doc_id").collect()} == kept[4]
    assert rows_of(again.groupBy("doc_id").agg(F.sum("length"))) == rows_of(read.groupBy("doc_id").agg(F.sum("length")))


def test_pipeline_over_an_empty_table(spark, tmp_path):
    table_of(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_awkward_rows(spark, tmp_path):
    blanks = prose(60, 4) + " " * 600_000 + prose(60, 5)
    table_of(spark, [*awkward_rows(), (50, blanks, "en", "a", 1), (51, "\n" * 600_000, None, None, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (7, 1, 0), (None, None, None)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()}
    assert {3, 7, 50} <= kept and not kept & {0, 1, 2, 4, 51}


def test_pages_with_columns_of_clashing_names(spark):
    rows = [(i, f"http://h{i % 3}.net/{('en', 'es')[i % 2]}/{i}") for i in range(30)] + [(99, None), (None, "x"), (5, "http://h2.net/es/5")]
    plain = spark.createDataFrame(rows, "page_id long, url string")
    clash = clashing(plain)
    for name in ("path", "rule", "verdict", "template", "purity", "segments", "parent", "n", "blocked"):
        clash = clash.selectExpr("*", f"'clash' AS {name}")
    judged = url_templates.judge_urls(plain)
    assert rows_of(url_templates.judge_urls(clash).select(*judged.columns)) == rows_of(judged)


def test_repeated_labels_repeat_no_page(spark):
    pages = spark.createDataFrame([(i, f"http://s.org/{('ads', 'news')[i % 2]}/x") for i in range(20)] + [(None, "http://s.org/ads/x")], "page_id long, url string")
    labels = [(i, i % 2 == 0) for i in range(20)] * 3 + [(0, False), (1, True), (2, None), (None, False), (77, True)]
    judged = url_templates.judge_urls(pages, labels=spark.createDataFrame(labels, "page_id long, blocked boolean")).collect()
    assert len(judged) == 21 and {r["verdict"] for r in judged if "ads" in r["path"]} == {"block"}
    assert {r["verdict"] for r in judged if "news" in r["path"]} == {"allow"}
    even = spark.createDataFrame([(0, True), (0, False), (1, None)], "page_id long, blocked boolean")
    assert {r["verdict"] for r in url_templates.judge_urls(pages, labels=even).collect()} == {"allow"}
