"""A quality classifier of rules: tree paths as conjunctions, lasso weights, Spark columns.

1. *Statistics.* Each text is described by about a dozen numbers (``STATISTICS``):
   lengths, shares of kinds of characters and words, repetition of words and lines,
   line ends. All are built-in Spark functions.
2. *Rules.* A random forest of shallow trees is fitted on statistics of labelled
   rows; every node of every tree is a rule, the conjunction of the conditions on
   the path to it, written as one interval for each statistic.
3. *Weights.* A logistic regression with an L1 penalty over the rules keeps few of
   them, each with a weight.
4. *Scoring.* The kept rules are compiled into one Spark column, so a table is
   scored in one pass without Python or a shuffle.

At most ``fit_rows`` labelled rows of each class are fitted, those of the smallest
hash of the id; rows are weighted back to the shares of all labelled rows. Ids are
chosen before any text is read, so only their number of texts travels.

Null text counts as empty; empty text has statistics 0 and is scored by them. Rows
with a null or other label, and ids with both labels, are not learned from. If one
class has no row, every score is the share of label 1 (0.5 without any row).
Repeated rows and ties score alike; other columns are kept, and existing columns
named like a result are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import require, table, third
from tripmill.session import settle

#: Labelled rows of each class that the model is fitted on at most: the only sampled step.
FIT_ROWS = 4000
TREES, DEPTH, LEAST_ROWS, SEED = 24, 3, 5, 17
#: Strength of the L1 penalty.
PENALTY = 0.002
THRESHOLD = 0.5

STATISTICS = (
    "log_words", "word_length", "letter_share", "upper_share", "digit_share", "symbol_share", "sign_word_share",
    "doubled_sign_share", "distinct_words", "distinct_lines", "line_words", "ended_lines",
)
Interval = tuple[float, float]  # above, up to


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of ``STATISTICS``; a text without words has 0 for all but the length."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = docs.withColumn("_text", text).withColumn("_trim", F.trim(F.regexp_replace("_text", r"\s+", " ")))
    parts = parts.withColumns(
        {
            "_words": F.when(F.col("_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_trim", " ")),
            "_lines": F.split(F.trim("_text"), r"\n"),
            "_letters": F.length(F.regexp_replace("_text", r"[^\p{L}]+", "")),
            "_upper": F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", "")),
            "_digits": F.length(F.regexp_replace("_text", r"[^\p{N}]+", "")),
            "_symbols": F.length(F.regexp_replace("_text", r"[\p{L}\p{N}\s.,;:'\"()?-]+", "")),
        }
    )
    parts = parts.withColumns(
        {
            "_n": F.size("_words").cast("double"),
            "_ended": F.size(F.split("_text", r"[.?!]\s*(?:\n|$)")) - 1,
        }
    )
    filled, lines = F.length("_trim") - F.col("_n") + 1, F.size("_lines").cast("double")
    share = lambda part, whole: F.when((F.col("_n") > 0) & (whole > 0), part / whole).otherwise(0.0)
    described = {
        "log_words": F.log1p("_n"),
        "word_length": share(filled, F.col("_n")),
        "letter_share": share(F.col("_letters"), filled),
        "upper_share": share(F.col("_upper"), F.col("_letters")),
        "digit_share": share(F.col("_digits"), filled),
        "symbol_share": share(F.col("_symbols"), filled),
        "sign_word_share": share(F.regexp_count("_trim", F.lit(r"(?:^|(?<= ))[^\p{L}\p{N} ]+(?= |$)")), F.col("_n")),
        "doubled_sign_share": share(F.regexp_count("_trim", F.lit(r"([^\p{L}\p{N} .])\1")), F.col("_n")),
        "distinct_words": share(F.size(F.array_distinct("_words")).cast("double"), F.col("_n")),
        "distinct_lines": share(F.size(F.array_distinct("_lines")).cast("double"), lines),
        "line_words": share(F.col("_n"), lines),
        "ended_lines": share(F.col("_ended").cast("double"), lines),
    }
    own = [F.col(f"`{c}`") for c in docs.columns if c not in STATISTICS]
    return parts.select(*own, *[described[name].cast("double").alias(name) for name in STATISTICS])


@dataclass(frozen=True)
class Rule:
    """A conjunction: each named statistic lies in its interval (above the first bound, up to the second)."""

    intervals: tuple[tuple[str, Interval], ...]

    def column(self) -> Column:
        bounds = [F.col(name) > low for name, (low, _) in self.intervals if low > -math.inf]
        return reduce(Column.__and__, bounds + [F.col(name) <= high for name, (_, high) in self.intervals if high < math.inf])

    def holds(self, row: dict) -> bool:
        return all(low < row[name] <= high for name, (low, high) in self.intervals)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules and the constant of a logistic score."""

    constant: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def column(self) -> Column:
        total = reduce(Column.__add__, [F.when(rule.column(), weight).otherwise(0.0) for rule, weight in self.rules], F.lit(self.constant))
        return 1 / (1 + F.exp(-total))


def tree_rules(debug_text: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """The distinct rules of a fitted forest, read from its printed trees: one for each node below a root."""
    found: dict[Rule, None] = {}
    path: list[tuple[str, bool, float]] = []
    for line in debug_text.splitlines():
        branch = re.search(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if "Tree" in line:
            path, base = [], None
        elif branch:
            indent = len(branch[1])
            base = indent if base is None else base
            del path[indent - base :]
            path.append((names[int(branch[2])], branch[3] == ">", float(branch[4])))
            bounds: dict[str, Interval] = {}
            for name, above, value in path:
                low, high = bounds.get(name, (-math.inf, math.inf))
                bounds[name] = (max(low, value), high) if above else (low, min(high, value))
            found[Rule(tuple(sorted(bounds.items())))] = None
    return list(found)


def learn(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> RuleModel:
    """Rules from labelled documents; the driver receives printed trees and weights, both bounded by the forest's size."""
    require(documents, id_col, text_col)
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("_most"))
        .where("label = _most")
        .select(F.col(id_col).alias("_id"), F.col("label").cast("double").alias("label"))
    )
    sizes = {int(r["label"]): r["count"] for r in known.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return RuleModel(40.0 if sizes.get(1) else -40.0 if sizes.get(0) else 0.0)
    order = (F.xxhash64("_id"), F.col("_id"))
    chosen = reduce(DataFrame.unionByName, [known.where(f"label = {k}").orderBy(*order).limit(fit_rows) for k in (0, 1)])
    texts = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    described = with_statistics(texts.join(F.broadcast(chosen), "_id")).drop("text")  # two numbers for each of 2 * fit_rows ids
    sample = settle(described.orderBy(*order, *STATISTICS).limit(2 * fit_rows), "fitted").coalesce(1)  # an id may stand on many rows
    fitted = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    if not fitted.get(0) or not fitted.get(1):
        return RuleModel(40.0 if fitted.get(1) else -40.0 if fitted.get(0) else 0.0)
    share = {k: sizes[k] / sum(sizes.values()) * sum(fitted.values()) / fitted[k] for k in (0, 1)}
    rows = sample.withColumn("weight", F.when(F.col("label") == 1, share[1]).otherwise(share[0])).orderBy(*order, *STATISTICS)
    rows = rows.withColumn("statistics", array_to_vector(F.array(*STATISTICS)))
    forest = RandomForestClassifier(
        featuresCol="statistics", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAST_ROWS,
        featureSubsetStrategy="onethird", maxBins=64, seed=SEED,
    ).fit(rows)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        odds = sizes[1] / sizes[0]
        return RuleModel(math.log(odds))
    hits = rows.select("label", "weight", array_to_vector(F.array(*[F.when(r.column(), 1.0).otherwise(0.0) for r in rules])).alias("hits"))
    fit = LogisticRegression(featuresCol="hits", labelCol="label", weightCol="weight", elasticNetParam=1.0, regParam=PENALTY, maxIter=100).fit(hits)
    kept = [(rule, float(weight)) for rule, weight in zip(rules, fit.coefficients.toArray()) if abs(weight) > 1e-6]
    return RuleModel(float(fit.intercept), tuple(kept))


def score(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds score and predicted."""
    require(docs, text_col)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted", *STATISTICS)]
    rated = with_statistics(docs.select(*own), text_col).select(*own, model.column().alias("score"))
    return rated.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def learn_from_tables(spark: SparkSession, sf_dir: str) -> RuleModel:
    """The model of a folder: labelled documents outside the held-out third."""
    documents, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    return learn(documents, labels.where(third() != 1))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(documents, learn_from_tables(spark, sf_dir))
    return scored.select("doc_id", (third() == 1).alias("held_out"), "score", "predicted")


QUERIES = {"op11_quality_rules": op11_quality_rules}
SQL: dict[str, str] = {}
