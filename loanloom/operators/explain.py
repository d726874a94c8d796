"""Shapley values of the boosted trees, importance and per-loan driver text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.columns import by_magnitude, let, ratio_or_zero
from loanloom.operators import tree_shap
from loanloom.operators.model import FEATURES, RiskModel

# Plain-language names of the model inputs, in lookup order.
FEATURE_LABELS = {
    "loan to income ratio": "Loan amount compared with income",
    "had delinquency": "Previous payment delinquency",
    "grade default rate": "Historical risk of borrower's credit grade",
    "region default rate": "Historical risk of borrower's region",
    "interest rate percentile in grade": "Interest rate compared with similar borrowers",
    "loan amount rank in grade": "Loan size compared with similar borrowers",
    "loan amount": "Loan amount",
    "interest rate": "Interest rate",
    "term months": "Loan term length",
    "dti": "Debt-to-income ratio",
    "annual income": "Annual income",
    "employment length": "Length of employment",
    "grade": "Credit grade",
    "home ownership": "Home ownership status",
    "purpose": "Stated loan purpose",
}

# Texts shown with the drivers.
NO_DRIVER = "No single factor stands out — risk is driven by a broad combination of smaller signals"
RAISES, LOWERS = "Increases risk", "Decreases risk"


# -- contributions --------------------------------------------------------------


def leaf_rules(spark: SparkSession, trees: GBTClassificationModel) -> list[tree_shap.Leaf]:
    """The leaves of a model, for several calls of ``shap_values``."""
    return tree_shap.leaves(spark, trees)


_tree_nodes = tree_shap.tree_nodes
base_value = tree_shap.mean_value


def shap_values(model: RiskModel, df: DataFrame, rules: list[tree_shap.Leaf] | None = None) -> DataFrame:
    """Add ``shap``, one log-odds contribution per feature, and ``shap_base`` to prepared or plain rows.

    Python work: Arrow batches against the broadcast leaves, whose size is bounded: tables of
    their shares (64 MB at most), or for deep trees their paths (rounds x 2^depth x depth x 28 bytes). Missing entries
    of a vector go where the trees send them.
    """
    spark = df.sparkSession
    rules = leaf_rules(spark, model.trees) if rules is None else rules
    known = tree_shap.tables(rules)
    shared = spark.sparkContext.broadcast(tree_shap.pack(rules) if known is None else known)
    shares = tree_shap.contributions if known is None else tree_shap.looked_up
    width = len(model.names)

    @F.arrow_udf("array<double>")
    def explain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
            yield pa.ListArray.from_arrays(ends, pa.array(shares(x, shared.value).ravel()))

    prepared = df if FEATURES in df.columns else model.prepare(df)
    return prepared.withColumn("shap", explain(vector_to_array(FEATURES))).withColumn(
        "shap_base", F.lit(base_value(rules))
    )


# -- reading the contributions --------------------------------------------------


def plain_label(name: str) -> str:
    """The label of one encoded feature name, by the rule of ``feature_label``."""
    plain = name.replace("num__", "").replace("cat__", "").replace("_", " ")
    prefixes = [label for key, label in FEATURE_LABELS.items() if plain.startswith(key)]
    return FEATURE_LABELS.get(plain) or (prefixes[0] if prefixes else plain)


def named_values(values: Column, names: Sequence[str]) -> Column:
    """array<double> -> array<struct<name, label, value>>. Labels are looked up here, once for all rows."""
    known = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(plain_label(n)).alias("label")) for n in names])

    def named(v: Column, i: Column) -> Column:
        own = F.element_at(known, i + 1)
        return F.struct(own["name"].alias("name"), own["label"].alias("label"), v.cast("double").alias("value"))

    return F.transform(values, named)


def global_importance(df: DataFrame, values: str = "shap", names: Sequence[str] | None = None) -> DataFrame:
    """Mean absolute contribution per feature position, largest first.

    With ``names`` the width is known, and all means come from one aggregate
    over the rows as they are; without, every row is unfolded first.
    """

    def size(value: Column) -> Column:
        return F.avg(F.abs(value.cast("double")))

    order = [F.col("importance").desc(), F.col("position")]
    if names is None:
        unfolded = df.select(F.posexplode(values).alias("position", "value"))
        return unfolded.groupBy("position").agg(size(F.col("value")).alias("importance")).orderBy(*order)
    means = df.agg(*[size(F.col(values)[i]).alias(f"m{i}") for i in range(len(names))])
    rows = [
        F.struct(F.lit(n).alias("feature"), F.lit(i).alias("position"), F.col(f"m{i}").alias("importance"))
        for i, n in enumerate(names)
    ]
    return means.select(F.inline(F.array(*rows))).orderBy(*order)


def top_by_magnitude(pairs: Column, n: int) -> Column:
    return F.slice(by_magnitude(pairs), 1, n)


def driver_text(pairs: Column, n: int = 3) -> Column:
    """ "name (+0.123); ..." of the n largest contributions by magnitude."""
    return F.array_join(
        F.transform(top_by_magnitude(pairs, n), lambda d: F.format_string("%s (%+.3f)", d["name"], d["value"])), "; "
    )


def increasing_drivers(pairs: Column, n: int = 3) -> Column:
    """Labels of the n largest risk-raising contributions; a fixed sentence when there is none."""
    rising = F.slice(F.filter(by_magnitude(pairs), lambda d: d["value"] > 0), 1, n)
    labels = F.transform(rising, lambda d: d["label"])
    return let(labels, lambda known: F.when(F.size(known) > 0, known).otherwise(F.array(F.lit(NO_DRIVER))))


def driver_breakdown(pairs: Column, n: int = 5) -> Column:
    """The n largest contributions with label, direction and percent of the largest."""

    def shown(d: Column, largest: Column) -> Column:
        return F.struct(
            d["label"].alias("driver"),
            F.when(d["value"] > 0, RAISES).otherwise(LOWERS).alias("direction"),
            (ratio_or_zero(F.abs(d["value"]), largest) * 100).alias("percent_of_max"),
        )

    def beside_largest(top: Column) -> Column:
        # Inside the lambda of ``shown`` the largest would be found again for every entry.
        largest = F.array_max(F.transform(top, lambda d: F.abs(d["value"])))
        return let(largest, lambda most: F.transform(top, lambda d: shown(d, most)))

    return let(top_by_magnitude(pairs, n), beside_largest)


def top_drivers(df: DataFrame, names: Sequence[str], n: int = 3, mode: str = "abs", values: str = "shap") -> DataFrame:
    """Add ``top_drivers``: driver text (``abs``) or labels of risk-raising features (``increasing``)."""
    pairs = named_values(F.col(values), names)
    if mode == "abs":
        return df.withColumn("top_drivers", driver_text(pairs, n))
    if mode == "increasing":
        return df.withColumn("top_drivers", increasing_drivers(pairs, n))
    raise ValueError(f"unknown driver mode: {mode}")


def feature_label(name: Column) -> Column:
    """Plain label of an encoded feature name: exact match, else the first label key it starts with, else itself."""
    plain = F.replace(F.replace(F.replace(name, F.lit("num__"), F.lit("")), F.lit("cat__"), F.lit("")), F.lit("_"), F.lit(" "))
    labels = F.array(
        *[F.struct(F.lit(k).alias("key"), F.lit(v).alias("label")) for k, v in FEATURE_LABELS.items()]
    )
    exact = F.try_element_at(F.filter(labels, lambda e: e["key"] == plain), F.lit(1))["label"]
    prefix = F.try_element_at(F.filter(labels, lambda e: plain.startswith(e["key"])), F.lit(1))["label"]
    return F.coalesce(exact, prefix, plain)


def label_features(names: DataFrame, column: str = "feature") -> DataFrame:
    """Add ``label`` to a table of feature names."""
    return names.withColumn("label", feature_label(F.col(column)))
