"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: compatibility forms and case, marks that hide letters,
homoglyphs of other scripts, and digits or signs that stand for letters inside a
word. Patterns are words and word beginnings, each with a weight; of the patterns
that match in one word the heaviest counts. Matches within an exception phrase
do not count. The sum is normalised by length, and a logistic curve over sum and
density gives a score from 0 to 1.

Lexicon, exceptions and curve are learned from labelled rows (``learn``). Null
text counts as empty and scores like any text without a match. Rows without a
label or text are scored alike; labels that are null are not learned from. With
no labelled row of either class every score is 0. Repeated rows score alike; other
columns are kept, and existing columns named like a result are replaced.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import map_rows, release, require, table, third
from tripmill.session import settle

#: Rows of each class that the query's model is fitted on, about: the only sampled step.
FIT_ROWS = 4000
#: Most patterns and exception phrases of a learned lexicon.
LEXICON_SIZE = 4000
EXCEPTIONS_SIZE = 2000
#: Least weight (log ratio of document shares) and least number of toxic rows of a pattern.
LEAST_WEIGHT = 2.5
LEAST_ROWS = 3
BEGINNINGS = (4, 5, 6, 8)
THRESHOLD = 0.7
#: Patterns that a task counts before it hands their counts on.
HELD_PATTERNS = 200_000

# fixed values: letters that look like Latin letters, and signs that stand for letters
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ø": "o", "ł": "l", "ɑ": "a",
}
LEET = dict(zip("01345678@$!|", "oieasgtbasil"))
HIDDEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"

_PLAIN = str.maketrans({**HOMOGLYPHS, **{c: None for c in HIDDEN}})
_SIGNS = re.compile(r"[01345678@$!|]+")
_WORD = re.compile(r"[^\W\d_]+")


def _unsign(found: re.Match) -> str:
    """One or two signs as letters where they stand for letters: before a letter, or digits after one."""
    signs, text, end = found[0], found.string, found.end()
    if len(signs) > 2:
        return signs
    followed = end < len(text) and text[end].isalpha()
    led = found.start() > 0 and text[found.start() - 1].isalpha()
    if followed and (led or not signs.isdigit()) or led and signs.isdigit() or followed and signs in ("0", "1", "3", "5"):
        return "".join([LEET[s] for s in signs])
    return signs


def fold(text: str) -> str:
    """Folded text: words of letters, one space between them and around the text."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_PLAIN)
    text = _SIGNS.sub(_unsign, text)
    return f" {' '.join(_WORD.findall(text))} "


@dataclass(frozen=True)
class Lexicon:
    """Patterns (folded; a trailing space ends a word) with weights, exception phrases, and the curve of the score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-12.0, 2.0, 2.0)  # constant, log sum, log density

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            machine.add_word(f" {pattern}", (len(pattern) + 1, weight, False))
        for phrase in self.exceptions:
            key = f" {phrase} "
            machine.add_word(key, (len(key), 0.0, True))
        machine.make_automaton()
        return machine


def _hits(machine, folded: str) -> dict[int, float]:
    """Heaviest weight by word start, without words inside exception phrases."""
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight, exception) in machine.iter(folded):
        start = end - length + 1
        if exception:
            spared.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    for first, last in spared:
        for start in [s for s in best if first <= s < last]:
            del best[start]
    return best


def _features(total: float, words: int) -> tuple[float, float]:
    """Log of the matched weight, and of the weight per square root of a thousand words."""
    return math.log1p(total), math.log1p(total / math.sqrt(1 + words / 1000))


def measure(machine, text: str | None) -> tuple[float, int]:
    return _measure(machine, fold(text or ""))


def _measure(machine, folded: str) -> tuple[float, int]:
    return sum(_hits(machine, folded).values()) if len(machine) else 0.0, folded.count(" ") - 1


def _curve(curve: tuple[float, float, float], total: float, words: int) -> float:
    a, b = _features(total, words)
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, curve[0] + curve[1] * a + curve[2] * b))))


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds score, predicted, n_matches and matched_weight."""
    require(docs, text_col)

    @F.arrow_udf("struct<score:double,n_matches:int,matched_weight:double>")
    def rate(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        machine = lexicon.automaton()
        for column in columns:
            rows = []
            for value in column:
                folded = fold(value.as_py() or "")
                hits = _hits(machine, folded) if lexicon.weights else {}
                total = sum(hits.values())
                rows.append((_curve(lexicon.curve, total, folded.count(" ") - 1), len(hits), total))
            yield pa.StructArray.from_arrays(
                [pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.float64())],
                ["score", "n_matches", "matched_weight"],
            )

    results = ("score", "predicted", "n_matches", "matched_weight")
    return docs.withColumn("_rated", rate(F.col(text_col))).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in results],
        F.col("_rated.score").alias("score"),
        (F.col("_rated.score") >= threshold).cast("int").alias("predicted"),
        F.col("_rated.n_matches").alias("n_matches"),
        F.col("_rated.matched_weight").alias("matched_weight"),
    )


def _patterns(folded: str) -> set[str]:
    words = set(folded.split())
    return {w[:n] for w in words for n in BEGINNINGS if len(w) >= n} | {f"{w} " for w in words if len(w) > 2}


def learn(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", key: Column | None = None, fit_rows: int | None = FIT_ROWS, sizes: dict[int, int] | None = None) -> Lexicon:
    """A lexicon from labelled rows; at most about ``fit_rows`` rows of each class, chosen by hash of ``key``, or all rows (None).

    ``sizes`` gives the rows of each class if the caller has counted them. The driver receives patterns (bounded by ``LEXICON_SIZE``), phrases
    (``EXCEPTIONS_SIZE``) and two numbers for each fitted row, or sums alone where all rows are fitted.
    """
    require(labelled, text_col, label_col)
    key = F.xxhash64(key if key is not None else F.col(text_col))
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), key.alias("_key"))
    if fit_rows is not None:
        if sizes is None:
            sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        if not sizes.get(0) or not sizes.get(1):
            return Lexicon(curve=(-40.0, 0.0, 0.0))
        share = F.when(F.col("label") == 1, F.lit(fit_rows / sizes[1])).otherwise(F.lit(fit_rows / sizes[0]))
        rows = rows.where(F.pmod("_key", F.lit(1 << 20)) < share * (1 << 20))

    def folded_rows(source: Iterator[dict]) -> Iterator[dict]:
        for row in source:
            yield {"folded": fold(row["text"] or ""), "label": row["label"]}

    sample = settle(map_rows(rows.select("text", "label"), folded_rows, "folded string, label int", lambda row: 64 + len(row["folded"])), "labelled")
    fitted = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    positives, negatives = fitted.get(1, 0), fitted.get(0, 0)
    if not positives or not negatives:
        return Lexicon(curve=(-40.0, 0.0, 0.0))

    def count_patterns(source: Iterator[dict]) -> Iterator[dict]:
        counts = (Counter(), Counter())

        def counted() -> Iterator[dict]:
            for pattern in counts[1]:
                yield {"pattern": pattern, "toxic": counts[1][pattern], "clean": 0}
            for pattern in counts[0]:
                yield {"pattern": pattern, "toxic": 0, "clean": counts[0][pattern]}
            counts[0].clear(), counts[1].clear()

        for row in source:
            counts[row["label"]].update(_patterns(row["folded"]))
            if len(counts[0]) + len(counts[1]) > HELD_PATTERNS:
                yield from counted()
        yield from counted()

    weight = F.log((F.col("toxic") + 0.5) / (positives + 1.0)) - F.log((F.col("clean") + 0.5) / (negatives + 1.0))
    chosen = (
        map_rows(sample, count_patterns, "pattern string, toxic bigint, clean bigint")
        .groupBy("pattern")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .withColumn("weight", weight)
        .where((F.col("toxic") >= LEAST_ROWS) & (F.col("weight") >= LEAST_WEIGHT) & (F.col("toxic") > 3 * F.col("clean")))
        .orderBy(F.desc(F.col("weight") * F.col("toxic")), "pattern")
        .limit(LEXICON_SIZE)
        .collect()
    )
    # a pattern seen with few rows by chance weighs less than one seen with many
    weights = {r["pattern"]: r["weight"] * r["toxic"] / (r["toxic"] + 10.0) for r in chosen}
    draft = Lexicon(weights)

    def count_phrases(source: Iterator[dict]) -> Iterator[dict]:
        machine, counts = draft.automaton(), (Counter(), Counter())
        for row in source:
            folded = row["folded"]
            phrases = set()
            for start in _hits(machine, folded) if weights else ():
                end = folded.find(" ", start + 1)
                if start:
                    phrases.add(folded[folded.rfind(" ", 0, start) + 1 : end])
                if (after := folded.find(" ", end + 1)) > 0:
                    phrases.add(folded[start + 1 : after])
            counts[row["label"]].update(phrases)
        for phrase in counts[1] | counts[0]:
            yield {"pattern": phrase, "toxic": counts[1][phrase], "clean": counts[0][phrase]}

    exceptions = (
        map_rows(sample, count_phrases, "pattern string, toxic bigint, clean bigint")
        .groupBy("pattern")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("clean") >= 5) & (F.col("clean") / negatives > 4 * F.col("toxic") / positives))
        .orderBy(F.desc("clean"), "pattern")
        .limit(EXCEPTIONS_SIZE)
        .collect()
    )
    final = Lexicon(weights, tuple(r["pattern"] for r in exceptions))

    def measured(source: Iterator[dict]) -> Iterator[dict]:
        machine = final.automaton()
        for row in source:
            total, words = _measure(machine, row["folded"])
            yield {"label": row["label"], "total": total, "words": words}

    points = map_rows(sample, measured, "label int, total double, words bigint")
    if fit_rows is None:
        return Lexicon(final.weights, final.exceptions, _fit_all(points))
    points = points.collect()  # bounded by fit_rows
    prior = (sizes[1] / positives, sizes[0] / negatives)
    return Lexicon(final.weights, final.exceptions, _fit([(p["label"], p["total"], p["words"]) for p in points], prior))


def _newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], free: tuple[int, ...] = (0, 1, 2)) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps; coefficients that are not ``free`` stay 0.

    ``sums`` gives, for coefficients, the second and first derivatives over the points.
    """
    own = np.array(free)
    ridge, b = np.array([1e-3, 0.3, 0.3]), np.zeros(3)
    b[own] = np.array([-3.0, 0.5, 0.5])[own]
    for _ in range(50):
        second, first = sums(b)
        step = np.linalg.solve((second + np.diag(ridge))[np.ix_(own, own)], (first - ridge * b)[own])
        b[own] += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b


def _fit(points: list[tuple[int, float, int]], weigh: tuple[float, float]) -> tuple[float, float, float]:
    """The curve of collected points, rising in both features."""
    x = np.array([(1.0, *_features(total, words)) for _, total, words in points])
    y = np.array([label for label, _, _ in points], float)
    w = np.where(y == 1, *weigh) / (sum(weigh) / 2)

    def sums(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        return x.T @ (x * (w * p * (1 - p))[:, None]), x.T @ (w * (y - p))

    b = _newton(sums)
    return float(b[0]), max(0.0, float(b[1])), max(0.0, float(b[2]))


def _fit_all(points: DataFrame) -> tuple[float, float, float]:
    """The curve of all points (label, total, words), which stay where they are: each step gets nine sums.

    Where a feature would fall, it is left out and the others are fitted without it.
    """
    total, words = F.col("total"), F.col("words")
    features = (F.lit(1.0), F.log1p(total), F.log1p(total / F.sqrt(1 + words / 1000)))
    # texts without a match are one point
    stored = settle(points.select("label", *[x.alias(f"x{i}") for i, x in enumerate(features)]).groupBy("label", "x0", "x1", "x2").count(), "points")
    x, n = [F.col(f"x{i}") for i in range(3)], F.col("count")

    def sums(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        linear = sum((x[i] * F.lit(float(b[i])) for i in range(1, 3)), x[0] * F.lit(float(b[0])))
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), linear))))
        pairs = [(i, j) for i in range(3) for j in range(i, 3)]
        found = stored.agg(*[F.sum(n * p * (1 - p) * x[i] * x[j]) for i, j in pairs], *[F.sum(n * (F.col("label") - p) * x[i]) for i in range(3)]).first()
        second = np.zeros((3, 3))
        for (i, j), value in zip(pairs, found):
            second[i, j] = second[j, i] = value
        return second, np.array(found[len(pairs) :])

    free = (0, 1, 2)
    while (b := _newton(sums, free))[1:].min() < 0:
        free = tuple(i for i in free if i != 1 + b[1:].argmin())
    return tuple(float(value) for value in b)


def learn_from_all(spark: SparkSession, sf_dir: str) -> Lexicon:
    """The lexicon of a folder from every labelled document; nothing is sampled or held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    # stored, so that their real size picks the join
    return learn(documents.join(settle(labels, "labels"), "doc_id"), fit_rows=None)


def learn_from_tables(spark: SparkSession, sf_dir: str) -> Lexicon:
    """The lexicon of a folder: a sample of the labelled documents outside the held-out third."""
    documents = table(spark, sf_dir, "documents").where(third() != 1).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    # ids are joined and chosen first, so that only the texts of the fitted rows leave their task
    known = documents.select("doc_id").join(labels, "doc_id")
    sizes = {int(r["toxic"]): r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, F.lit(FIT_ROWS / max(1, sizes.get(1, 0)))).otherwise(F.lit(FIT_ROWS / max(1, sizes.get(0, 0))))
    chosen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)).distinct()
    few = settle(chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(4 * FIT_ROWS), "chosen")
    return learn(documents.join(F.broadcast(few), "doc_id"), key=F.col("doc_id"), sizes=sizes)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(documents, learn_from_tables(spark, sf_dir))
    return scored.select("doc_id", (third() == 1).alias("held_out"), "score", "predicted", "n_matches")


QUERIES = {"op2_toxicity": op2_toxicity}
SQL: dict[str, str] = {}
