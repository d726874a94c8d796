"""Mixing to target weights with soft domain membership.

A classifier fitted on labelled rows gives every document a posterior over domains. Nonnegative document rates are
then fitted by projected gradient on the least squares between the expected tokens of each domain,
``sum_d rate_d * tokens_d * posterior_dk``, and its target. Sums over documents are aggregations; the driver sees
a few numbers for each pair of domains and pass, and a model of bounded size.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Sequence
from itertools import accumulate
from math import log
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shared import materialise
from .common import let, words_of

log_of_fit = logging.getLogger(__name__)


class Classifier(NamedTuple):
    """For each domain the log odds of a text without any known feature, and what each known one adds."""

    domains: tuple[str, ...]
    priors: tuple[float, ...]
    words: tuple[str, ...]
    hashes: tuple[int, ...]
    weights: tuple[tuple[float, ...], ...]
    temperature: float


class Mix(NamedTuple):
    """Steps of the fit, the targets, and what the fitted rates give in expectation."""

    steps: tuple[tuple[float, ...], ...]
    targets: tuple[float, ...]
    reached: tuple[float, ...]


def _letter_words(text: Column) -> Column:
    """The words of a text in lower case, letters only; empty strings may stand at its ends."""
    return F.split(F.lower(text), r"[^\p{L}]+")


def _marks(text: Column, words: Column) -> Column:
    """Marks of the text's surface, which start with a sign that no word holds."""
    size = F.greatest(F.length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")) / size

    found = {
        "§empty": F.size(words) == 0,
        "§short": F.size(words) < 20,
        "§same": F.size(F.array_distinct(words)) < 0.3 * F.size(words),
        "§upper": share(r"[^\p{Lu}]+") > 0.4,
        "§signs": share(r"[\p{L}\p{N}\s.,]+") > 0.05,
        "§digits": share(r"[^0-9]+") > 0.2,
    }
    return F.array_compact(F.array(*[F.when(test, name) for name, test in found.items()]))


def features_of(text: Column) -> Column:
    """The distinct words of a text and its marks; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.array_distinct(_letter_words(text)), "")
    return F.concat(words, let(words_of(text), lambda w: _marks(text, w)))


def _read(text: Column, model: Classifier) -> Column:
    """``tokens`` and ``posterior`` of a text, its words looked up before they are made distinct."""
    text = F.coalesce(text, F.lit(""))
    if model.words:
        known = F.array_distinct(F.filter(_letter_words(text), lambda w: w.isin(*model.words)))
    else:
        known = F.array().cast("array<string>")

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("tokens"),
            _posterior(F.concat(known, _marks(text, words)), model).alias("posterior"),
        )

    return let(words_of(text), of)


def fit_classifier(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, min_docs: int = 5, min_score: float = 20.0, min_ratio: float = 3.0
) -> Classifier:
    """Naive Bayes over which of the features that tell the domains apart a text has.

    ``labels`` has ``doc_id, domain``. Of more than ``max_labelled`` labelled rows a share of about that many is
    used, drawn by a hash of the id. Features are all words and marks of the surface that ``min_docs`` documents or
    more have, whose counts have a G statistic of ``min_score`` at least, and that are ``min_ratio`` times as
    frequent in one domain as in the others (frequent words that only tell long texts from short ones are not);
    their number is bounded by the labelled sample alone. The temperature that divides the log odds is the best of a few on the same
    rows, so that posteriors of long texts don't all come out as 0 or 1.
    """
    known = labels.filter("doc_id IS NOT NULL AND domain IS NOT NULL").select("doc_id", "domain").dropDuplicates(["doc_id"])
    share = min(1.0, max_labelled / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("labelled")), F.lit(1 << 30)) < int(share * (1 << 30)))
    read = materialise(drawn.join(docs.select("doc_id", "text"), "doc_id").select("domain", features_of(F.col("text")).alias("words")))
    sizes = {r["domain"]: r["n"] for r in read.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = tuple(sorted(sizes))
    if not domains:
        return Classifier((), (), (), (), (), 1.0)
    total = sum(sizes.values())
    seen = {d: F.count(F.when(F.col("domain") == d, 1)) for d in domains}
    counts = read.select("domain", F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), *[n.alias(f"n{k}") for k, n in enumerate(seen.values())]
    )

    def g(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    score = sum(
        (
            g(F.col(f"n{k}"), F.col("n") * (sizes[d] / total))
            + g(F.lit(sizes[d]) - F.col(f"n{k}"), (F.lit(total) - F.col("n") + 0.5) * (sizes[d] / total))
            for k, d in enumerate(domains)
        ),
        F.lit(0.0),
    )
    ratio = F.greatest(
        *[
            (F.col(f"n{k}") + 0.5) / (sizes[d] + 1.0) * (total - sizes[d] + 1.0) / (F.col("n") - F.col(f"n{k}") + 0.5)
            for k, d in enumerate(domains)
        ],
        F.lit(0.0),
    )
    rows = (
        counts.filter(F.col("n") >= min_docs)
        .select("word", *[f"n{k}" for k in range(len(domains))], score.alias("score"), ratio.alias("ratio"), F.xxhash64("word").alias("hash"))
        .filter((F.col("score") >= min_score) & (F.col("ratio") >= min_ratio))
        .orderBy(F.desc("score"), "word")
        .collect()
    )
    odds = [[(row[f"n{k}"] + 0.5) / (sizes[d] + 1.0) for row in rows] for k, d in enumerate(domains)]
    model = Classifier(
        domains,
        tuple(log(sizes[d] / total) + sum(log(1 - p) for p in odds[k]) for k, d in enumerate(domains)),
        tuple(r["word"] for r in rows),
        tuple(r["hash"] for r in rows),
        tuple(tuple(log(p / (1 - p)) for p in own) for own in odds),
        1.0,
    )
    return model._replace(temperature=_best_temperature(read, model))


def _best_temperature(read: DataFrame, model: Classifier) -> float:
    choices = (1.0, 2.0, 4.0, 8.0, 16.0)
    rated = materialise(read.select("domain", _log_odds(F.col("words"), model).alias("odds")))
    loss = []
    for t in choices:
        p = _softmax(F.col("odds"), t)
        own = F.get(p, F.array_position(F.array(*map(F.lit, model.domains)), F.col("domain")).cast("int") - 1)
        loss.append(F.avg(-F.log(F.greatest(own, F.lit(1e-12)))).alias(f"t{t:g}"))
    found = rated.agg(*loss).first()
    return min(choices, key=lambda t: found[f"t{t:g}"] or 0.0)


def _numbers(values: tuple[float, ...]) -> Column:
    """An array literal, written as one text so that the plan stays short."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _log_odds(features: Column, model: Classifier) -> Column:
    if not model.words:
        return _numbers(model.priors)
    # The words lie in order of their hash slots, so that a look-up compares with the few of one slot. Words are
    # letters and marks, so none holds a separator.
    slots = 1 << (2 * len(model.words)).bit_length()
    order = sorted(range(len(model.words)), key=lambda i: model.hashes[i] % slots)
    filled = Counter(h % slots for h in model.hashes)
    starts = F.split(F.lit(",".join(map(str, accumulate((filled[s] for s in range(slots)), initial=0)))), ",").cast("array<int>")
    words = F.split(F.lit(",".join(model.words[i] for i in order)), ",")

    def place(word: Column) -> Column:
        def of(slot: Column) -> Column:
            here = F.sequence(F.get(starts, slot), F.get(starts, slot + 1) - 1)
            return F.get(F.filter(here, lambda i: F.get(words, i) == word), F.lit(0))

        return let(F.pmod(F.xxhash64(word), F.lit(slots)).cast("int"), of)

    def odds(at: Column) -> Column:
        return F.array(
            *[
                F.aggregate(at, F.lit(prior), lambda s, i: s + F.get(_numbers(tuple(weights[j] for j in order)), i))
                for prior, weights in zip(model.priors, model.weights)
            ]
        )

    return let(F.array_compact(F.transform(features, place)), odds)


def _softmax(odds: Column, temperature: float) -> Column:
    def softmax(x: Column) -> Column:
        scaled = F.transform(x, lambda v: F.exp((v - F.array_max(x)) / temperature))
        return let(scaled, lambda e: F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda s, y: s + y)))

    return let(odds, softmax)


def _posterior(features: Column, model: Classifier) -> Column:
    """Posteriors in the order of ``model.domains``."""
    return _softmax(_log_odds(features, model), model.temperature)


def _rate(posterior: Column, steps: tuple[tuple[float, ...], ...]) -> Column:
    """A document's rate after the given steps: each moves it against the gradient and projects it to 0 or more."""
    if not steps:
        return F.lit(1.0)
    moves = F.split(F.lit(";".join(",".join(map(repr, s)) for s in steps)), ";")

    def step(rate: Column, move: Column) -> Column:
        pull = F.aggregate(F.zip_with(move, posterior, lambda g, p: g * p), F.lit(0.0), lambda s, x: s + x)
        return F.greatest(F.lit(0.0), rate - pull)

    return F.aggregate(F.transform(moves, lambda m: F.split(m, ",").cast("array<double>")), F.lit(1.0), step)


#: What a step's sums are: squared rates, domain tokens, and products of posteriors over documents of positive rate.
Sums = Callable[[tuple[tuple[float, ...], ...], np.ndarray], tuple[float, np.ndarray, np.ndarray]]


def descend(
    sums: Sums,
    target: np.ndarray,
    tokens: float,
    tolerance: float = 1e-4,
    length: float = 1e7,
    most_steps: int = 12,
    most_newton: int = 60,
) -> tuple[tuple[tuple[float, ...], ...], np.ndarray]:
    """Projected gradient steps to the least squares of domain tokens against ``target``; (steps, tokens reached).

    ``sums`` are taken over all documents, after the given steps and one more by ``nu``. A step has its gradient
    taken at its end, so that it may be of any ``length``: the multipliers of the posteriors that it moves by make a
    convex function of as many variables as there are domains least, which Newton's method does. Ends when the
    targets are met within ``tolerance`` of their total, when a step changes nothing, or after ``most_steps``.
    """
    size = tolerance * target.sum()

    def at(nu: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        square, reached, products = sums(steps, nu)
        value = nu @ nu / (2 * length) + nu @ target / tokens + square / (2 * tokens)
        return value, nu / length + (target - reached) / tokens, np.eye(len(nu)) / length + products / tokens, reached

    steps: tuple[tuple[float, ...], ...] = ()
    before = None
    while True:
        nu = np.zeros(len(target))
        value, slope, curvature, reached = at(nu)
        still = before is not None and np.abs(reached - before).max() <= size / 10
        if np.abs(reached - target).max() <= size or still or len(steps) >= most_steps:
            return steps, reached
        before = reached
        for _ in range(most_newton):
            if np.abs(slope).max() <= tolerance * 1e-4:
                break
            newton, part = -np.linalg.solve(curvature, slope), 1.0
            found = at(newton + nu)
            while found[0] > value + 1e-4 * part * (slope @ newton) and part > 1e-6:
                part /= 2
                found = at(nu + part * newton)
            if part <= 1e-6:  # as near as rounding lets it come
                break
            nu = nu + part * newton
            value, slope, curvature, _ = found
        steps = (*steps, tuple(map(float, nu)))


def fit_mix(
    read: DataFrame,
    domains: tuple[str, ...],
    weights: dict[str, float],
    total: float | None = None,
    tolerance: float = 1e-4,
) -> Mix:
    """Nonnegative rates for documents ``posterior, tokens`` whose expected domain tokens come nearest, by least
    squares, to ``weights`` times ``total``.

    The default total is the least at which no domain of positive weight has to shrink. Targets that no rates meet
    end at the nearest reachable totals, which are no further off than no mix at all; what is reached is returned,
    and logged as a warning if a target is missed.
    """
    k = len(domains)
    p = [F.col("posterior")[i] for i in range(k)]
    native = [x or 0.0 for x in read.agg(*[F.sum(F.col("tokens") * p[i]) for i in range(k)]).first()] if k else []
    tokens = sum(native)
    if not tokens:
        return Mix((), (0.0,) * k, (0.0,) * k)
    share = [max(0.0, weights.get(d, 0.0)) for d in domains]
    share = [w / sum(share) for w in share] if sum(share) else [n / tokens for n in native]
    total = total or max(n / w for n, w in zip(native, share) if w > 0)
    targets = [w * total for w in share]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def sums(steps: tuple[tuple[float, ...], ...], nu: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        rate, t = F.col("rate"), F.col("tokens")
        moved = read.select("posterior", "tokens", _rate(F.col("posterior"), (*steps, tuple(map(float, nu)))).alias("rate"))
        square, *rest = moved.agg(
            F.sum(t * rate * rate), *[F.sum(t * rate * p[i]) for i in range(k)],
            *[F.sum(F.when(rate > 0, t * p[i] * p[j])) for i, j in pairs],
        ).first()
        rest = [float(x or 0.0) for x in rest]
        products = np.zeros((k, k))
        for (i, j), x in zip(pairs, rest[k:]):
            products[i, j] = products[j, i] = x
        return float(square or 0.0), np.array(rest[:k]), products

    steps, reached = descend(sums, np.array(targets), tokens, tolerance)
    missed = np.abs(reached - targets).max() > tolerance * total
    told = ", ".join(f"{d} {r:.0f} of {t:.0f}" for d, r, t in zip(domains, reached, targets))
    log_of_fit.log(logging.WARNING if missed else logging.INFO, "tokens reached of target: %s", told)
    return Mix(steps, tuple(targets), tuple(map(float, reached)))


def mixed_rates(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float],
    max_labelled: int = 20_000,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with a struct ``mix``: ``tokens`` (words), ``domain`` (the
    likeliest), ``posterior`` (a map), ``rate``, ``copies``, and ``target`` and ``reached``, the expected tokens of
    that domain in the whole mix as they are wanted and as the rates give them.

    ``copies`` is the rate, rounded up with the probability of its fraction by a hash of the id, and at least one
    for documents whose likeliest domain has a positive weight, so that mixing drops none of those. Null and
    empty texts have no tokens and whatever posterior an empty text has; null labels and labels of unknown
    documents count for nothing, of repeated labels one counts; without any label every rate is 1. Repeated rows
    get equal rates; an empty table gives an empty result. A column ``mix`` of ``docs`` is replaced.

    Texts are judged in one pass, whose result is stored with the columns kept; the fit reads posteriors and tokens
    alone. Only the labelled sample is shuffled with its texts.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != "mix"]
    model = fit_classifier(docs, labels, max_labelled)
    if not model.domains:
        none = F.create_map().cast("map<string,double>")
        mix = F.struct(
            F.size(words_of(F.col("text"))).cast("long").alias("tokens"),
            F.lit(None).cast("string").alias("domain"),
            none.alias("posterior"),
            F.lit(1.0).alias("rate"),
            F.lit(1).alias("copies"),
            F.lit(None).cast("double").alias("target"),
            F.lit(None).cast("double").alias("reached"),
        )
        return docs.select(*[F.col(f"`{c}`") for c in kept], mix.alias("mix"))
    row = F.struct("doc_id", *[F.col(f"`{c}`") for c in kept if c != "doc_id"]).alias("row")
    judged = docs.select(row, _read(F.col("text"), model).alias("read"))
    read = materialise(judged.select("row", "read.tokens", "read.posterior"))
    fitted = fit_mix(read.select("posterior", "tokens"), model.domains, weights)
    wanted = F.array(*[F.lit(weights.get(d, 0.0) > 0) for d in model.domains])
    names, p = F.array(*map(F.lit, model.domains)), F.col("posterior")
    chance = F.pmod(F.xxhash64("row.doc_id", F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    best = F.array_position(p, F.array_max(p)).cast("int") - 1
    keep_one = F.when(F.get(wanted, best), 1).otherwise(0)
    mix = let(
        _rate(p, fitted.steps),
        lambda rate: F.struct(
            F.col("tokens"),
            F.get(names, best).alias("domain"),
            F.map_from_arrays(names, p).alias("posterior"),
            rate.alias("rate"),
            F.greatest(keep_one, F.floor(rate + chance).cast("int")).alias("copies"),
            F.get(_numbers(fitted.targets), best).alias("target"),
            F.get(_numbers(fitted.reached), best).alias("reached"),
        ),
    )
    return read.select(*[F.col("row")[c].alias(c) for c in kept], mix.alias("mix"))


def repeated(docs: DataFrame, labels: DataFrame, weights: dict[str, float], **how: float) -> DataFrame:
    """The rows of ``docs`` as often as their ``copies`` say, with their own columns.

    Nulls and empty texts are treated as ``mixed_rates`` says; repeated rows, being equal, are repeated alike; an empty
    table stays empty. Targets that cannot be met give the nearest mix, never more than a corpus of about their total.
    """
    plain = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("source_row"))
    mixed = mixed_rates(plain, labels, weights, keep=["doc_id", "source_row"], **how)
    return mixed.select("source_row", F.explode(F.array_repeat(F.lit(0), F.col("mix")["copies"]))).select("source_row.*")


def label_domains(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` from quality and toxicity marks: toxic, else high or low; unmarked rows go."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain")).filter("domain IS NOT NULL")
