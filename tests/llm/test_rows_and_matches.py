"""Rows that share an id, matches against a plain search, recall, and samples of very large classes."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tripmill.llm import common, jaccard_join, language_id, packing, toxicity
from tripmill.llm.common import table, third

SF = SMALL.replace("0.001", "0.01")


def prose(seed: int, words: int = 120) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(words))


def near(text: str, at: int) -> str:
    words = text.split()
    words[at] = "changed"
    return " ".join(words)


def test_near_copies_are_decided_by_row(spark):
    a, b, clean = prose(1), prose(2), prose(3)
    rows = [(1, a), (2, near(a, 9)), (2, clean), (None, near(a, 30)), (None, b), (None, near(b, 5)), (4, prose(4)), (4, prose(4)), (5, ""), (5, ""), (None, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, component_id string")
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    found = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    chosen = [(i, t) for i, t in found if t in (b, near(b, 5))]
    assert len(chosen) == 1 and chosen[0][0] == 0
    assert sorted(set(found) - set(chosen)) == sorted({(1, a), (2, clean), (4, prose(4)), (5, ""), (0, "")})
    assert len(found) == 1 + 1 + 1 + 1 + 2 + 1  # two empty texts of one id stay, as they link with nothing


def test_matches_equal_a_plain_search():
    rng = random.Random(8)
    letters = "abcd"
    word = lambda low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    for _ in range(60):
        weights = {word(1, 3) + (" " if rng.random() < 0.5 else ""): round(rng.uniform(1, 9), 2) for _ in range(12)}
        exceptions = tuple({f"{word(1, 3)} {word(1, 3)}" for _ in range(6)})
        folded = " " + " ".join(word(1, 5) for _ in range(60)) + " "
        starts = [i for i, c in enumerate(folded[:-1]) if c == " "]
        best = {s: max((w for p, w in weights.items() if folded.startswith(f" {p}", s)), default=0.0) for s in starts}
        spared = [(i, i + len(e) + 1) for e in exceptions for i in starts if folded.startswith(f" {e} ", i)]
        plain = {s: w for s, w in best.items() if w and not any(first <= s < last for first, last in spared)}
        assert toxicity._hits(toxicity.Lexicon(weights, exceptions).automaton(), folded) == plain


@pytest.fixture(scope="module")
def lexicon(spark):
    return toxicity.learn_from_tables(spark, SF)


def test_toxic_rows_are_found(spark, lexicon):
    scored = toxicity.score(table(spark, SF, "documents").select("doc_id", "text"), lexicon).where(third() == 1)
    rows = scored.join(table(spark, SF, "labels"), "doc_id").select("toxic", "predicted").collect()
    found = [r.predicted for r in rows if r.toxic == 1]
    assert sum(found) >= 0.7 * len(found) > 0
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 1


def test_ids_chosen_first_give_the_same_lexicon(spark, lexicon):
    documents, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels").select("doc_id", "toxic")
    assert toxicity.learn(documents.where(third() != 1).join(labels, "doc_id"), key=F.col("doc_id")) == lexicon


def test_a_language_is_sampled_however_large(spark, monkeypatch):
    """The sampling bound of a language never becomes zero."""
    bound = lambda n, fit: max(1, min(n, fit) * (1 << 62) // n)
    assert bound(10**12, 2500) > 10**9 and bound(100, 2500) == 1 << 62
    docs = table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    filters = language_id.learn(docs, key=F.col("doc_id"), fit_rows=10)
    assert set(filters.languages) == {r.lang for r in docs.select("lang").distinct().collect()}


def test_a_worker_keeps_one_model():
    first = common.kept("a", lambda: np.zeros(3))
    assert common.kept("a", lambda: 1) is first
    assert common.kept("b", lambda: 2) == 2 and common.kept("a", lambda: 3) == 3
    common.release()
    assert common.kept("a", lambda: 4) == 4
    assert packing.encoder is not None
    common.release()


def test_the_pipeline_learns_toxicity_from_every_labelled_document(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    words = {1: "vile grond", 0: "calm river"}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1][:120]
    rows = [(i, f"{words[i % 4 == 0]} word{i % 7}" + (" zorblax" if i in held and i % 4 == 0 else "")) for i in range(400)]
    labels = [(i, int(i % 4 == 0)) for i in range(300)] + [(0, 1), (None, 1), (301, None)]
    spark.createDataFrame([*rows, (None, "vile")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    fitted, real = [], toxicity.settle

    def counted(frame, purpose):
        stored = real(frame, purpose)
        if purpose == "labelled":
            fitted.append(stored.count())
        return stored

    monkeypatch.setattr(toxicity, "settle", counted)
    monkeypatch.setattr(toxicity, "FIT_ROWS", 10)
    docs = spark.createDataFrame([(i, text, "en", "web", len(text)) for i, text in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.reject_toxic(spark, docs, str(tmp_path)).collect()}
    assert fitted == [300]  # all labelled documents, held-out ones too
    assert kept == {i for i, _ in rows if i % 4}
    assert "zorblax " in toxicity.learn_from_all(spark, str(tmp_path)).weights  # a word of held-out documents alone


def test_the_curve_of_all_points_is_that_of_collected_ones(spark, monkeypatch):
    points = [(1, 0.5 * i, 20 * i) for i in range(1, 30)] + [(0, 0.1 * i, 50 + i) for i in range(20)] + [(0, 0.0, i) for i in range(100)]
    frame = spark.createDataFrame(points, "label int, total double, words long")
    assert toxicity._fit_all(frame) == pytest.approx(toxicity._fit(points, (1.0, 1.0)), abs=1e-6)
    falling = [(label, total, 10 + int(90 * total)) for label, total, _ in points if label] + [(0, t, 100_000) for t in (1.0, 5.0, 14.0)] + [(0, 0.0, 5)]
    curve = toxicity._fit_all(spark.createDataFrame(falling, "label int, total double, words long"))
    assert min(curve[1:]) >= 0
    # patterns are counted alike however many a task holds
    rows = spark.createDataFrame([("vile grond bark", 1)] * 4 + [("calm river", 0)] * 9, "text string, toxic int")
    whole = toxicity.learn(rows, fit_rows=None)
    monkeypatch.setattr(toxicity, "HELD_PATTERNS", 2)
    assert whole.weights and toxicity.learn(rows, fit_rows=None) == whole
