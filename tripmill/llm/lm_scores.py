"""Language-model scores by stupid backoff, with n-gram tables that grow with the corpus.

Words are lower-cased (A-Z) runs without white space bytes. The vocabulary is every
word that occurs ``LEAST_COUNT`` times at least; all other words are one unknown
word, as usual in such models. Counts of words and of word pairs cover all documents.
64-bit hashes stand for words and for pairs; a wrong count needs a collision.

Documents are dealt by hash into chunks. A chunk sends its distinct words with their
counts to the parts of the word table, which is dealt by ranges of the hash, and gets
the counts over the corpus back; then the same with its word pairs. So counts combine
before every shuffle, a word or pair that is in every document is one row a chunk, and
no table is gathered or broadcast: the driver gets sums only. Each document is then
scored in its chunk: a pair that occurs elsewhere in the corpus scores its count,
without this document's own, over the count of its first word; any other pair backs
off to ``BACKOFF`` times the smoothed share of its second word. The first word of a
document follows a start mark.

Texts without words (or null) have no pairs and a null score. Equal texts score
alike. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import require, slices, table
from tripmill.llm.jaccard_join import word_hashes

LEAST_COUNT = 5
BACKOFF = 0.4
#: Text of a chunk, and words of a part of an n-gram table, in the mean: more input makes more of them.
CHUNK_BYTES, PART_WORDS = 6 << 20, 1_000_000
#: Stand for the unknown word and the start mark among the hashes of words.
UNKNOWN, START = np.uint64(0x9D5C0F3A7B21E864), np.uint64(0x3E8B61D7A4C90F25)
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_WORDS, _PAIRS = 0, 1
_SENT = "chunk bigint, kind int, part int, grams binary, counts binary"
_BACK = "chunk bigint, kind int, part int, counts binary"


def _words(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Per slice: its rows, the hashes of all words, and where each text's words begin (with the end)."""
    for batch in source:
        for piece in slices([batch], "text", 1 << 20):
            texts = [(t or "").encode() for t in piece.column("text").to_pylist()]
            hashes, starts = word_hashes(b" ".join([*texts, b""]))
            yield piece, hashes, np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))


def _count_words(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0

    def counted() -> pa.RecordBatch:
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.record_batch([pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "n"])

    for _, hashes, _ in _words(source):
        held.append(hashes)
        weight += len(hashes)
        if weight > 4_000_000:
            yield counted()
            held, weight = [], 0
    if held:
        yield counted()


def _packed(values: np.ndarray) -> bytes:
    """64-bit values by byte planes, which compress where the high bytes are zero."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def _distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of a chunk, and how often each occurs; slices are combined first."""
    if not grams:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts = [np.unique(g, return_counts=True) for g in grams]
    found, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return found, np.bincount(at, np.concatenate([n for _, n in parts]), len(found)).astype(np.int64)


def _sent(chunk: int, kind: int, grams: np.ndarray, counts: np.ndarray, parts: int) -> pa.Table:
    """Rows of a chunk's n-grams for each part of the table; parts are ranges of the hash."""
    width = (1 << 64) // parts + 1
    bounds = np.searchsorted(grams, np.array([i * width for i in range(1, parts)], np.uint64))
    bounds = [0, *bounds.tolist(), len(grams)]
    filled = [i for i in range(parts) if bounds[i] < bounds[i + 1]]
    pieces = [(grams[bounds[i] : bounds[i + 1]], counts[bounds[i] : bounds[i + 1]]) for i in filled]
    return pa.table(
        {
            "chunk": pa.array([chunk] * len(filled), pa.int64()),
            "kind": pa.array([kind] * len(filled), pa.int32()),
            "part": pa.array(filled, pa.int32()),
            "grams": pa.array([_packed(np.diff(g, prepend=np.uint64(0))) for g, _ in pieces], pa.binary()),
            "counts": pa.array([_packed(n) for _, n in pieces], pa.binary()),
        }
    )


def _sum_part(rows: pa.Table) -> pa.Table:
    """For every row of a part of the table: the counts of its n-grams over all rows."""
    grams = [np.cumsum(_unpacked(g), dtype=np.uint64) for g in rows.column("grams").to_pylist()]
    counts = [_unpacked(n) for n in rows.column("counts").to_pylist()]
    found, at = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.zeros(len(found), np.uint64)
    np.add.at(totals, at, np.concatenate(counts))
    back = np.split(totals[at], np.cumsum([len(g) for g in grams])[:-1])
    return rows.select(["chunk", "kind", "part"]).append_column("counts", pa.array([_packed(n) for n in back], pa.binary()))


def _received(back: pa.Table, kind: int) -> np.ndarray:
    """Counts over the corpus of a chunk's sorted distinct n-grams."""
    rows = sorted((part, n) for k, part, n in zip(*(back.column(c).to_pylist() for c in ("kind", "part", "counts"))) if k == kind)
    return np.concatenate([_unpacked(n) for _, n in rows] or [np.zeros(0, np.uint64)]).astype(np.int64)


class _Model:
    """What tasks know besides the counts of their own n-grams: sums over the corpus."""

    def __init__(self, parts: int, total: int, vocabulary: int, unknown: int, starts: int):
        self.parts, self.total, self.vocabulary, self.unknown, self.starts = parts, total, vocabulary, unknown, starts

    def send_words(self, docs: pa.Table) -> pa.Table:
        grams = [h for _, h, _ in _words(docs.to_batches()) if len(h)]
        return _sent(docs.column("chunk")[0].as_py(), _WORDS, *_distinct(grams), self.parts)

    def _pairs(self, docs: pa.Table, back: pa.Table) -> Iterator[tuple]:
        """Per slice: its rows, where each text's words begin, and of each word: pair, count of the word before it, own count."""
        slices_ = list(_words(docs.to_batches()))
        words = np.unique(np.concatenate([np.unique(h) for _, h, _ in slices_] or [np.zeros(0, np.uint64)]))
        counts = _received(back, _WORDS)
        for piece, hashes, bounds in slices_:
            n = counts[np.searchsorted(words, hashes)] if len(hashes) else np.zeros(0, np.int64)
            known = n >= LEAST_COUNT
            second, n_second = np.where(known, hashes, UNKNOWN), np.where(known, n, self.unknown)
            first, n_first = np.empty_like(second), np.empty_like(n_second)
            first[1:], n_first[1:] = second[:-1], n_second[:-1]
            begins = bounds[:-1][np.diff(bounds) > 0]
            first[begins], n_first[begins] = START, self.starts
            pairs = first * _FIRST
            pairs = (pairs ^ (pairs >> np.uint64(29)) ^ second) * _SECOND
            yield piece, bounds, pairs ^ (pairs >> np.uint64(32)), n_first, n_second

    def send_pairs(self, docs: pa.Table, back: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(("chunk", "kind", "part", "grams", "counts"), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))})
        grams = [p for _, _, p, _, _ in self._pairs(docs, back) if len(p)]
        return _sent(docs.column("chunk")[0].as_py(), _PAIRS, *_distinct(grams), self.parts)

    def score(self, docs: pa.Table, back: pa.Table) -> pa.Table:
        ids, sizes, means, shares = [], [], [], []
        if docs.num_rows:
            slices_ = list(self._pairs(docs, back))
            grams = np.unique(np.concatenate([np.unique(p) for _, _, p, _, _ in slices_]))
            counts = _received(back, _PAIRS)
            for piece, bounds, pairs, n_first, n_second in slices_:
                size = np.diff(bounds)
                owner = np.repeat(np.arange(len(size)), size)
                at = np.searchsorted(grams, pairs)
                _, example, own = np.unique(owner * len(grams) + at, return_index=True, return_counts=True)
                n, owner = counts[at[example]], owner[example]
                elsewhere = n > own
                value = np.where(
                    elsewhere,
                    np.log(np.maximum(n - own, 1)) - np.log(n_first[example]),
                    np.log(BACKOFF * (n_second[example] + 1) / (self.total + self.vocabulary + 1)),
                )
                none = size == 0
                over = np.maximum(size, 1)
                ids.append(piece.column("id"))
                sizes.append(size)
                means.append(pa.array(np.bincount(owner, value * own, len(size)) / over, pa.float64(), mask=none))
                shares.append(pa.array(np.bincount(owner, own * ~elsewhere, len(size)) / over, pa.float64(), mask=none))
        return pa.table(
            {
                "id": pa.chunked_array(ids, docs.schema.field("id").type),
                "n_words": pa.array(np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)),
                "mean_log_score": pa.chunked_array(means, pa.float64()),
                "backoff_share": pa.chunked_array(shares, pa.float64()),
            }
        )


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, mean_log_score, backoff_share."""
    require(docs, id_col, text_col)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(text_col).alias("text"))
    counts = texts.mapInArrow(_count_words, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    known = F.col("n") >= LEAST_COUNT
    sums = counts.agg(F.sum("n"), F.count_if(known), F.sum(F.when(known, F.col("n")))).first()
    total, vocabulary, covered = (n or 0 for n in sums)
    starts, size = texts.agg(F.count_if(F.col("text").rlike(r"[^\x20\x09-\x0D]")), F.sum(F.octet_length("text"))).first()
    model = _Model(max(least, total // PART_WORDS), total, vocabulary, total - covered, starts)

    # copies with different ids go to different chunks
    chunk = F.pmod(F.xxhash64(id_col, text_col), F.lit(max(least, (size or 0) // CHUNK_BYTES)))
    chunks = docs.select(chunk.alias("chunk"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).groupBy("chunk")
    words = chunks.applyInArrow(lambda docs: model.send_words(docs), _SENT).groupBy("part").applyInArrow(_sum_part, _BACK)
    sent = chunks.cogroup(words.groupBy("chunk")).applyInArrow(lambda docs, back: model.send_pairs(docs, back), _SENT)
    pairs = sent.groupBy("part").applyInArrow(_sum_part, _BACK)
    scored = T.StructType([T.StructField("id", docs.schema[id_col].dataType)])
    scored = scored.add("n_words", T.LongType()).add("mean_log_score", T.DoubleType()).add("backoff_share", T.DoubleType())
    both = chunks.cogroup(words.union(pairs).groupBy("chunk"))
    return both.applyInArrow(lambda docs, back: model.score(docs, back), scored).withColumnRenamed("id", id_col)


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"))
    return scored.withColumns({c: F.round(c, 6) for c in ("mean_log_score", "backoff_share")})


QUERIES = {"op10_lm_scores": op10_lm_scores}
SQL = {
    "op10_lm_scores": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), words AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
        counts AS (SELECT word, count(*) AS n FROM words GROUP BY word),
        vocabulary AS (SELECT word, n FROM counts WHERE n >= 5),
        sizes AS (SELECT sum(n) AS total, (SELECT count(*) FROM vocabulary) AS v,
                         (SELECT count(*) FROM docs WHERE len(words) > 0) AS starts FROM counts),
        known AS (SELECT word, n FROM vocabulary
                  UNION ALL SELECT '<unknown> ', (SELECT total FROM sizes) - (SELECT coalesce(sum(n), 0) FROM vocabulary)),
        coded AS (SELECT w.r, w.i, coalesce(v.word, '<unknown> ') AS b FROM words w LEFT JOIN vocabulary v ON w.word = v.word),
        pairs AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY i), '<start> ') AS a, b FROM coded),
        own AS (SELECT r, a, b, count(*) AS own FROM pairs GROUP BY r, a, b),
        total AS (SELECT a, b, sum(own) AS n FROM own GROUP BY a, b),
        valued AS (
            SELECT o.r, o.own, t.n > o.own AS elsewhere,
                   CASE WHEN t.n > o.own THEN ln(t.n - o.own) - ln(CASE WHEN o.a = '<start> ' THEN s.starts ELSE ka.n END)
                        ELSE ln(0.4 * (kb.n + 1) / (s.total + s.v + 1)) END AS value
            FROM own o JOIN total t ON o.a = t.a AND o.b = t.b CROSS JOIN sizes s
            LEFT JOIN known ka ON o.a = ka.word JOIN known kb ON o.b = kb.word
        ), sums AS (
            SELECT r, sum(value * own) / sum(own) AS mean_log_score,
                   sum(CASE WHEN elsewhere THEN 0 ELSE own END) / sum(own) AS backoff_share
            FROM valued GROUP BY r
        )
        SELECT doc_id, len(words) AS n_words, round(mean_log_score, 6) AS mean_log_score, round(backoff_share, 6) AS backoff_share
        FROM docs LEFT JOIN sums USING (r)
    """
}
