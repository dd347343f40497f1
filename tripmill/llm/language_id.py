"""Language identification with bit-sliced Bloom filters of character n-grams.

One filter serves all languages: each slot holds a mask with one bit per
language, and a language's n-grams set its bit in ``HASHES`` slots each. Looking
up an n-gram ANDs its slots, which gives the mask of all languages that contain
it (and, rarely, of some that do not). A text's n-grams are looked up at once;
the set bits of each language are counted, the counts corrected for the filter's
false positives, and the language with most n-grams wins.

An n-gram belongs to a language if it is common there: its share of the
language's n-grams reaches ``LEAST_SHARE`` and a fifth of its largest share in
any language. Case is ignored; anything but letters counts as one blank.

Null text and texts without a letter give ``und`` and score 0; so do all texts if
nothing was learned. Ties go to the first language in order. Rows may repeat;
other columns are kept, and existing columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import require, slices, table, third
from tripmill.session import settle

#: Rows of each language that the filters are fitted on, about: the only sampled step.
FIT_ROWS = 2500
NGRAM = 4
HASHES = 3
#: Slots of the filter; a power of two.
SLOTS = 1 << 20
#: n-grams of one language at most, the most frequent first: keeps the filter sparse.
GRAMS_PER_LANGUAGE = 40_000
LEAST_SHARE = 2e-6
UNKNOWN = "und"
PREDICTED = "struct<lang_pred:string,score:double,n_grams:int>"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case code point for letters, 32 for everything else."""
    out = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def gram_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts in one array, and where each text's n-grams begin (with the end)."""
    joined = "\n\n\n\n".join(texts)
    codes = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.array([len(t) + 4 for t in texts], np.int64)
    codes = np.concatenate([np.full(1, 32, np.uint32), codes, np.full(NGRAM + 4, 32, np.uint32)])
    owner = np.concatenate([[0], np.cumsum(lengths)])
    blank = codes == 32
    keep = ~(blank[1:] & blank[:-1])  # of a run of blanks only the first is left
    keep = np.concatenate([[True], keep])
    kept, at = codes[keep], np.cumsum(keep)
    keys = np.zeros(max(0, len(kept) - NGRAM + 1), np.uint64)
    for i in range(NGRAM):
        keys = (keys + kept[i : i + len(keys)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    keys ^= keys >> np.uint64(31)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    keys ^= keys >> np.uint64(29)
    bounds = np.minimum(np.maximum(at[np.minimum(owner, len(at) - 1)] - 1, 0), len(keys))
    bounds[-1] = max(bounds[-1], bounds[-2]) if len(bounds) > 1 else 0
    return keys, bounds


def _slot(keys: np.ndarray, i: int) -> np.ndarray:
    return ((keys >> np.uint64(20 * i)) & np.uint64(SLOTS - 1)).astype(np.int64)


@dataclass(frozen=True)
class Filters:
    """Languages in order, the slot masks (one column per 64 languages), and each language's false positive rate."""

    languages: tuple[str, ...]
    masks: np.ndarray
    false_rate: np.ndarray

    @staticmethod
    def build(grams: dict[str, np.ndarray]) -> "Filters":
        languages = tuple(sorted(grams))
        masks = np.zeros((-(-max(1, len(languages)) // 64), SLOTS), np.uint64)
        rates = np.zeros(len(languages))
        for number, language in enumerate(languages):
            bit = np.uint64(1) << np.uint64(number % 64)
            for i in range(HASHES):
                masks[number // 64][_slot(grams[language], i)] |= bit
            rates[number] = np.mean(masks[number // 64] & bit != 0) ** HASHES
        return Filters(languages, masks, rates)

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected n-gram counts (texts x languages), and the number of n-grams of each text."""
        keys, bounds = gram_keys(texts)
        sizes = np.diff(bounds)
        out = np.zeros((len(texts), len(self.languages)))
        slots = [_slot(keys, i) for i in range(HASHES)]
        for column, masks in enumerate(self.masks):
            found = masks[slots[0]]
            for slot in slots[1:]:
                found &= masks[slot]
            for number in range(64 * column, min(64 * column + 64, len(self.languages))):
                bits = (found >> np.uint64(number % 64)) & np.uint64(1)
                sums = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
                hits = sums[bounds[1:]] - sums[bounds[:-1]]
                rate = self.false_rate[number]
                out[:, number] = np.maximum(0, (hits - rate * sizes) / max(1e-9, 1 - rate))
        return out, sizes


def predict(docs: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """Adds lang_pred, score (the winner's share of all counts) and n_grams."""
    require(docs, text_col)

    @F.arrow_udf(PREDICTED)
    def decide(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            names, scores, sizes = [], [], []
            for piece in slices([pa.record_batch([column], ["text"])], "text", 1 << 20):
                texts = [v or "" for v in piece.column(0).to_pylist()]
                counts, grams = filters.counts(texts)
                lettered = [any(map(str.isalpha, t)) for t in texts]
                total = counts.sum(axis=1)
                best = counts.argmax(axis=1) if filters.languages else np.zeros(len(texts), int)
                for i, has in enumerate(lettered):
                    known = has and bool(filters.languages)
                    names.append(filters.languages[best[i]] if known else UNKNOWN)
                    scores.append(float(counts[i, best[i]] / total[i]) if known and total[i] > 0 else 0.0)
                    sizes.append(int(grams[i]) if has else 0)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sizes, pa.int32())], ["lang_pred", "score", "n_grams"])

    results = ("lang_pred", "score", "n_grams")
    return docs.withColumn("_lang", decide(F.col(text_col))).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in results], *[F.col(f"_lang.{c}").alias(c) for c in results]
    )


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, fit_rows: int = FIT_ROWS) -> Filters:
    """Filters from about ``fit_rows`` rows of each language, chosen by hash of ``key``; whole texts are counted.

    The driver receives at most ``GRAMS_PER_LANGUAGE`` n-gram hashes of each language.
    """
    require(labelled, text_col, lang_col)
    key = F.xxhash64(key if key is not None else F.col(text_col))
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.pmod(key, F.lit(1 << 62)).alias("_key")
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Filters((), np.zeros((1, SLOTS), np.uint64), np.zeros(0))
    limit = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, max(1, min(n, fit_rows) * (1 << 62) // n))])
    sample = rows.where(F.col("_key") < limit[F.col("lang")]).select("lang", "text")

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for piece in slices([batch], "text", 4 << 20):
                langs, texts = piece.column("lang").to_pylist(), piece.column("text").to_pylist()
                for lang in sorted(set(langs)):
                    keys, bounds = gram_keys([t for la, t in zip(langs, texts) if la == lang])
                    grams, counts = np.unique(keys[: bounds[-1]], return_counts=True)
                    yield pa.record_batch(
                        [pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "gram", "n"]
                    )

    counted = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    counted = settle(counted, "grams")
    totals = F.create_map(*[F.lit(x) for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect() for x in (r["lang"], float(r["n"]))])
    shares = counted.withColumn("share", F.col("n") / totals[F.col("lang")])
    peaks = shares.groupBy("gram").agg(F.max("share").alias("peak"))
    common = settle(shares.join(peaks, "gram").where((F.col("share") >= LEAST_SHARE) & (F.col("n") >= 2) & (F.col("share") * 5 >= F.col("peak"))), "common-grams")
    grams: dict[str, list[int]] = {}
    for lang in sorted(sizes):  # a language has a bounded number of n-grams here, so each list is small
        top = common.where(F.col("lang") == lang).orderBy(F.desc("share"), "gram").limit(GRAMS_PER_LANGUAGE)
        grams[lang] = [r["gram"] for r in top.select("gram").collect()]
    return Filters.build({lang: np.array(found, np.int64).view(np.uint64) for lang, found in grams.items()})


def learn_from_tables(spark: SparkSession, sf_dir: str) -> Filters:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return learn(documents.where(third() != 1), key=F.col("doc_id"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = predict(documents, learn_from_tables(spark, sf_dir))
    return found.select("doc_id", (third() == 1).alias("held_out"), "lang_pred", "score", "n_grams")


QUERIES = {"op3_language_id": op3_language_id}
SQL: dict[str, str] = {}
