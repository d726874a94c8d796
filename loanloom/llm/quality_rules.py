"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_of


class Rule(NamedTuple):
    """A metric has to lie in [low, high] in every text of ``min_words`` words or more."""

    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in that is it for was as with be by on are this an at from or "
    "de la le les et des un une du que en est pour dans ou sur il au par pas avec "
    "der die und das den von zu mit ist im dem nicht ein eine auf sich für es auch "
    "el los las y del se con por su para como al lo más"
).split()

SYMBOLS = "#*$%&|<>"

#: Production thresholds. Ratios are against words unless they name lines.
RULES = (
    Rule("n_words", low=10),
    Rule("repeat_word_ratio", high=0.2),
    Rule("mean_word_chars", low=2.0, high=15.0),
    Rule("symbol_ratio", high=0.3),
    Rule("stop_word_ratio", low=0.02, min_words=50),
    Rule("dup_line_ratio", high=0.5, min_words=50),
    Rule("bullet_line_ratio", high=0.9, min_words=50),
    Rule("ellipsis_line_ratio", high=0.3, min_words=50),
)

#: The two rules that are judged apart, as the base verdict.
BASE_RULES = RULES[:2]

WINDOW = 5


def _repeated(words: Column) -> Column:
    """Words covered by windows whose word sequence stands in the text more than once.

    Hashes tell at once that no window repeats. Otherwise the windows themselves are sorted, equal neighbours keep
    their positions, and each position covers up to the next one.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def covered(rows: Column) -> Column:
        def same_key(x: Column, j: Column) -> Column:
            return F.coalesce(F.get(rows, j)["key"] == x["key"], F.lit(False))

        same = F.filter(rows, lambda x, j: same_key(x, j - 1) | same_key(x, j + 1))
        positions = F.array_sort(F.transform(same, lambda x: x["at"]))
        return let(
            positions,
            lambda p: F.aggregate(
                p,
                F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                lambda s, x: F.struct(
                    (s["n"] + F.least(F.lit(WINDOW), x - s["last"])).alias("n"), x.alias("last")
                ),
                lambda s: s["n"],
            ),
        )

    def windows(i: Column) -> Column:
        return F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("key"), i.alias("at"))

    def hashed(codes: Column) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(codes, i + k) for k in range(WINDOW)]))

    distinct = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda codes: let(hashed(codes), lambda h: F.size(F.array_distinct(h)) == F.size(h)),
    )
    return (
        F.when(F.size(words) <= WINDOW, 0)
        .when(distinct, 0)
        .otherwise(let(F.array_sort(F.transform(starts, windows)), covered))
    )


def measures(text: Column) -> Column:
    """One struct of counts; a null text is empty."""
    text = F.coalesce(text, F.lit(""))

    def counts(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            _repeated(words).cast("long").alias("n_repeat_words"),
            let(
                lines,
                lambda x: F.struct(
                    F.size(x).cast("long").alias("n"),
                    (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
                    F.size(F.filter(x, lambda y: y.rlike(r"^\s*[-*•]\s"))).cast("long").alias("bullet"),
                    F.size(F.filter(x, lambda y: y.rlike(r"(\.\.\.|…)\s*$"))).cast("long").alias("ellipsis"),
                ),
            ).alias("lines"),
        )

    return let(words_of(text), counts)


def _metrics(m: Column) -> dict[str, Column]:
    words, lines = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["lines"]["n"], F.lit(1))
    return {
        "n_words": m["n_words"],
        "mean_word_chars": m["word_chars"] / words,
        "symbol_ratio": m["n_symbols"] / words,
        "stop_word_ratio": m["n_stop_words"] / words,
        "repeat_word_ratio": m["n_repeat_words"] / words,
        "dup_line_ratio": m["lines"]["dup"] / lines,
        "bullet_line_ratio": m["lines"]["bullet"] / lines,
        "ellipsis_line_ratio": m["lines"]["ellipsis"] / lines,
    }


def passes(m: Column, rules: tuple[Rule, ...]) -> Column:
    """The conjunction of a threshold table over a struct of ``measures``."""
    values = _metrics(m)

    def one(rule: Rule) -> Column:
        value, ok = values[rule.metric], F.lit(True)
        if rule.low is not None:
            ok = ok & (value >= rule.low)
        if rule.high is not None:
            ok = ok & (value <= rule.high)
        return ok | (m["n_words"] < rule.min_words)

    return reduce(lambda a, b: a & b, map(one, rules), F.lit(True))


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The counts of a text with ``base_failed`` and ``kept``, as one expression that counts once wherever it ends up
    in a plan, in a filter too. ``kept`` is up to the given table alone."""

    def judged(m: Column) -> Column:
        return m.withField("base_failed", ~passes(m, BASE_RULES)).withField("kept", passes(m, rules))

    return let(measures(text), judged)


def assess(docs: DataFrame, rules: tuple[Rule, ...] = RULES, into: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``into``: the counts, ``base_failed`` and ``kept``.

    A projection: no shuffle and no user function. A null or empty text has no words, fails a rule on their number
    and so is not kept by the production table; repeated rows are judged alike. A column of the name ``into`` is
    replaced; an empty table gives an empty result.
    """
    return docs.withColumn(into, verdict(F.col("text"), rules))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns, clashing names included.

    A null or empty text has no words and goes, if the table asks for words; repeated rows pass or go together; an
    empty table stays empty.
    """
    return docs.filter(verdict(F.col("text"), rules)["kept"])
