"""Operators of the llm package: edge rows, brute force and library results."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

from compare import connect, difference
from tripmill.llm import (
    components,
    embedding_dedup,
    exact_dedup,
    jaccard_join,
    language_id,
    lm_scores,
    packing,
    pieces,
    registry,
    suffix_dedup,
    token_counts,
    toxicity,
)

ALPHABET = "abcdeE 'sSt\n\t \x1c\xa0éÀß漢字🎉12,.!<|endoftext|>_-ͅΣσ "
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, n_tokens string"


def strange_texts(number: int, seed: int = 7) -> list[str]:
    rng = random.Random(seed)
    own = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(number)]
    return [*own, "", " ", "x <|endoftext|> y", "a" * 700, "!!!???... don't I'LL we've", "\x00 nul", "  two  spaces  "]


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(words))


@pytest.fixture(scope="module")
def edge_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, copies and near copies, with clashing extra columns."""
    rng = random.Random(3)
    base = prose(rng, 300)
    near = base.split()
    near[10] = "changed"
    passage = prose(rng, 120)
    texts = [None, "", " \t\n", "one two", "one  two", "ONE two", base, base, " ".join(near), passage + " " + prose(rng, 80), prose(rng, 60) + " " + passage, "z" * 3000, "long " * 30_000]
    rows = [(i, t, "en" if t else None, None, None, i, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[6], (None, "no id", None, None, None, None, None), (None, None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near_components(rows):
    """Smallest id reachable by links of similarity 0.8, by comparing all pairs that share a shingle."""
    sets, parent, lists = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}, defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in sets.items():
        for j in {j for s in own for j in lists[s]}:
            shared = len(own & sets[j])
            if 100 * shared >= 80 * (len(own) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in own:
            lists[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def removed(rows, length=400):
    """Bytes kept and number of spans when every repeated window is cut."""
    windows = Counter(t[p : p + length] for _, t in rows for p in range(len(t) - length + 1))
    out = {}
    for i, text in rows:
        spans = suffix_dedup.merged_spans([(p, p + length) for p in range(len(text) - length + 1) if windows[text[p : p + length]] > 1])
        out[i] = (len(text), sum(b - a for a, b in spans), len(spans), hashlib.sha256(suffix_dedup.without(text, spans)).hexdigest())
    return out


def test_token_counts_equal_the_library_at_every_prefix():
    library = Tokenizer.from_file(token_counts.vocabulary_path())
    own = token_counts.PrefixCounter(token_counts.vocabulary_path())
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in strange_texts(300):
        assert own.count(text) == size(text)
    for text in strange_texts(40, seed=9)[:46]:
        stored = own.prefixes(text)
        assert [stored.at(i) for i in range(len(text) + 1)] == [size(text[:i]) for i in range(len(text) + 1)]
        for budget in (0, 3, 9):
            fitting = [i for i in range(len(text) + 1) if size(text[:i]) <= budget]
            assert stored.longest_within(budget) == max(fitting)


def test_token_counts_on_edges(edge_docs, no_docs):
    rows = token_counts.count_tokens(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {r.n_tokens for r in rows if r.n_bytes == 0} == {0}
    assert all(r.fit_bytes < r.n_bytes for r in rows if r.over_limit) and any(r.over_limit for r in rows)
    assert token_counts.count_tokens(no_docs).count() == 0
    assert token_counts.prefix_counts(edge_docs.where("doc_id < 6")).where("doc_id = 3").first().prefix_tokens[-1] == 2


def test_toxicity(spark, edge_docs, no_docs):
    assert toxicity.fold("an 1d10t, m0ron! $tupid сl0wn 2023 wow!!!") == " an idiot moron stupid clown wow "
    lexicon = toxicity.Lexicon({"idiot ": 5.0, "stup": 4.0}, ("not stupid",), (-3.0, 2.0, 2.0))
    texts = ["You 1D1OT", "stupidity", "not stupid", "", None, "fine"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    found = {r.doc_id: r for r in toxicity.score(docs, lexicon).collect()}
    assert [found[i].predicted for i in range(6)] == [1, 1, 0, 0, 0, 0]
    assert toxicity.score(edge_docs, lexicon).count() == edge_docs.count()
    assert toxicity.score(no_docs, lexicon).count() == 0
    nothing = toxicity.learn(spark.createDataFrame([], "text string, toxic int"))
    assert toxicity.score(docs, nothing).where("predicted = 1").count() == 0
    rng = random.Random(1)
    rows = [(prose(rng, 40) + (" wretched" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(200)]
    learned = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"))
    assert "wretched " in learned.weights
    assert toxicity.score(spark.createDataFrame(rows, "text string, toxic int"), learned).where("predicted <> toxic").count() == 0


def test_toxicity_held_out(spark, database):
    rows = toxicity.op2_toxicity(spark, SMALL).toPandas().merge(database.execute("SELECT doc_id, toxic FROM labels").df(), on="doc_id")
    assert ((rows.predicted == 1) & (rows.toxic == 0)).sum() <= 1
    assert rows.score.between(0, 1).all()


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


def test_language_id(spark, database, edge_docs, no_docs):
    rows = language_id.op3_language_id(spark, SMALL).toPandas().merge(database.execute("SELECT doc_id, lang FROM documents").df(), on="doc_id")
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    filters = language_id.Filters.build({"aa": np.array([1, 2], np.uint64), "bb": np.array([3], np.uint64)})
    found = language_id.predict(edge_docs, filters).collect()
    assert {r.lang_pred for r in found if not r.text or not r.text.strip()} == {"und"}
    assert language_id.predict(no_docs, filters).count() == 0
    empty = language_id.learn(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in language_id.predict(edge_docs, empty).collect()} == {"und"}


def test_language_filter_holds_every_ngram_and_corrects_counts():
    text = "the quick brown fox jumps over the lazy dog " * 3
    keys, bounds = language_id.gram_keys([text])
    filters = language_id.Filters.build({"xx": np.unique(keys[: bounds[-1]]), "yy": np.zeros(0, np.uint64)})
    counts, sizes = filters.counts([text, "", "1234"])
    assert counts[0, 0] == pytest.approx(sizes[0], rel=0.01) and counts[0, 1] < 1 and counts[1].sum() == 0


def test_exact_dedup_edges(edge_docs, no_docs):
    rows = exact_dedup.exact_groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    kept = sorted(((r.doc_id is None, r.doc_id or 0) for r in rows if r.kept))
    assert kept == [(False, i) for i in (0, 2, 3, 5, 6, 8, 9, 10, 11, 12)] + [(True, 0)]
    assert {r.group_size for r in rows if r.keep_id == 6} == {3}
    stays = exact_dedup.keep_first(edge_docs)
    assert stays.columns == edge_docs.columns and stays.count() == len(kept)
    assert exact_dedup.exact_groups(no_docs).count() == exact_dedup.keep_first(no_docs).count() == 0


def test_grace_spills_and_compares_contents():
    rng = random.Random(2)
    texts = [f"text {rng.randint(0, 400)} {'x' * 300}" for _ in range(3000)]
    rows = [{"_hash": zlib.crc32(t.encode()) % 8, "_text": t, "_id": i, "_rows": 1} for i, t in enumerate(texts)]  # most hashes collide
    merged = {r["_text"]: (r["_id"], r["_rows"]) for r in exact_dedup.grace(rows, budget=20_000)}
    assert merged == {t: (texts.index(t), texts.count(t)) for t in set(texts)}


def test_packing_equals_the_library_and_fills_without_gaps(spark, edge_docs, no_docs):
    library, own = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY)), packing.encoder(public_tokenizers.path(packing.VOCABULARY))
    texts = strange_texts(600)
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    rows = packing.pack_documents(edge_docs).toPandas().sort_values(["sequence_id", "offset"])
    assert (rows.offset == (rows.offset + rows.length).groupby(rows.sequence_id).shift(fill_value=0)).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 2048
    assert rows.length.sum() == sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in edge_docs.collect())
    assert packing.pack_documents(no_docs).count() == 0


def test_plan_places_every_rank_once():
    rng = random.Random(5)
    histogram = {length: rng.randint(1, 40) for length in rng.sample(range(1, 101), 60)}
    filled, seen = defaultdict(list), Counter()
    for length, first, end, sequence, each, offset in packing.plan_slots(histogram, 100):
        for i in range(end - first):
            filled[sequence + i // each].append((offset + (i % each) * length, length))
            seen[length] += 1
    assert seen == histogram
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    rooms: list[int] = []  # best fit, one document at a time
    for length in sorted((k for k, n in histogram.items() for _ in range(n)), reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms.remove(min(fitting))
        rooms.append((min(fitting) if fitting else 100) - length)
    assert len(filled) == len(rooms)


def test_jaccard_join_matches_brute_force(spark, edge_docs, no_docs, database):
    rows = database.execute("SELECT doc_id, text FROM documents").fetchall()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.op8_ngram_jaccard_join(spark, SMALL).collect()}
    assert found == near_components(rows)
    edges = {r.doc_id: r for r in jaccard_join.near_groups(edge_docs).collect()}
    assert edges[8].component_id == 6 and edges[0].component_id == 0 and edges[0].n_shingles == 0 and edges[3].component_id == edges[5].component_id == 3
    assert jaccard_join.near_groups(no_docs).count() == 0
    assert jaccard_join.keep_one(edge_docs).where("doc_id = 8").count() == 0


def test_jaccard_join_long_lists(spark):
    """A large group of near copies with members that only link to some of it, and a passage that many documents share."""
    rng = random.Random(11)
    base, passage, rows = prose(rng, 120).split(), prose(rng, 25), []
    for i in range(80):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = f"w{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, prose(rng, 20) + " " + passage) for i in range(60)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == near_components(rows)


def test_bitmaps_never_exclude_similar_sets(spark):
    rng = np.random.default_rng(13)
    rows, expected = [], {}
    for i in range(300):
        whole = rng.integers(0, 1 << 63, rng.integers(2, 400), np.int64).astype(np.uint64)
        share = rng.random() * 0.3
        left, right = np.unique(whole[rng.random(len(whole)) >= share]), np.unique(whole[rng.random(len(whole)) >= share])
        expected[i] = jaccard_join.similar(left, right)
        rows.append((i, len(left), *jaccard_join.marks_of(left).tolist(), len(right), *jaccard_join.marks_of(right).tolist()))
    sides = [f"{side}{c}" for side in ("_l", "_r") for c in ("size", *range(jaccard_join.MARKS))]
    docs = spark.createDataFrame(rows, "i int, " + ", ".join(f"{c} bigint" for c in sides))
    close = {r.i for r in docs.where(jaccard_join._may_be_similar("_l", "_r")).collect()}
    assert {i for i, yes in expected.items() if yes} <= close and 0 < len(close) < len(rows)


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    assert {r.node: r.component for r in components.connected(chain).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_embedding_dedup(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 24))
    near = base[:30] + 0.02 * rng.normal(size=(30, 24))
    vectors = [*base.tolist(), *near.tolist(), *base[:5].tolist(), None, [0.0] * 24, [float("nan")] * 24, [None] * 24, [], [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, v, None if i == 3 else i % 2) for i, v in enumerate(vectors)]
    found = {r.vec_id: r for r in embedding_dedup.vector_groups(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    usable = [(i, np.array(v), k) for i, v, k in rows if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = Counter()
    for i, v, k in usable:
        for j, w, m in usable:
            if i != j and k == m and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
                links[i] += 1
    assert {i: r.n_links for i, r in found.items()} == {i: links[i] for i in found}
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_dedup.vector_groups(empty).count() == 0


def test_suffix_dedup_matches_brute_force(spark, edge_docs, no_docs):
    rng = random.Random(8)
    passages = [prose(rng, n) for n in (70, 90, 200)]
    texts = [prose(rng, rng.randint(1, 90)) + " " + rng.choice(passages)[rng.randint(0, 40) :] + " é" + prose(rng, rng.randint(1, 60)) for _ in range(40)]
    texts += [texts[0], "ab" * 500, "q" * 900, "", "short"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = removed([(i, t.encode()) for i, t in rows])
    digest = lambda df: {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}
    assert digest(suffix_dedup.removal_report(docs)) == wanted
    assert suffix_dedup.removal_report(no_docs).count() == 0
    assert suffix_dedup.removal_report(edge_docs).count() == edge_docs.count()
    firsts = {r.doc_id: r.text for r in suffix_dedup.keep_first(docs).collect()}
    assert len(firsts) < len(rows) and all(p in " ".join(firsts.values()) for p in (passages[0][50:], passages[2][50:]))
    again = removed([(i, t.encode()) for i, t in firsts.items()])
    assert sum(r[1] for r in again.values()) < sum(r[1] for r in wanted.values()) / 10


def test_suffix_dedup_hot_minimizers(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    rng = random.Random(18)
    passage = prose(rng, 90)
    rows = [(i, prose(rng, 30) + passage + prose(rng, 30)) for i in range(12)]
    found = {r.doc_id: r.n_removed for r in suffix_dedup.removal_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {i: r[1] for i, r in removed([(i, t.encode()) for i, t in rows]).items()}
    copies = [(20 + i, rows[i % 3][1][: 300 + 40 * i] + "~" + rows[i % 3][1][300 + 40 * i :]) for i in range(12)]
    rows += copies + [(40, "q" * 900), (41, "q" * 700), (42, "ab" * 400), (43, rows[5][1] + rows[5][1]), (None, rows[2][1] + "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    digest = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_report(docs).collect()}
    assert digest == removed([(i, t.encode()) for i, t in rows])
    earlier = suffix_dedup.repeated_spans(docs)[1].where("not later")
    least = {r.k1: r.least for r in suffix_dedup.repeated_spans(docs)[0].collect()}
    marked = {(least[r.k1], p) for r in earlier.collect() for p in range(r.low, r.high)}
    seen, wanted = set(), set()
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        for p in range(len(text) - 399):
            if text[p : p + 400] in seen:
                wanted.update((i, q) for q in range(p, p + 400))
            seen.add(text[p : p + 400])
    assert marked == wanted


def test_pieces_equal_the_library(edge_docs, no_docs):
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path()), pieces.PieceCoder(pieces.model_path())
    texts = [t.replace("▁", "") for t in strange_texts(800)]
    assert [a.tolist() for a in own.encode(texts)] == library.encode(texts)
    assert [own.decode(a.tolist()) for a in own.encode(texts)] == texts
    assert own.segmenter.reused > 0
    rows = pieces.round_trips(edge_docs).collect()
    assert all(r.round_trip for r in rows) and {r.n_pieces for r in rows if r.n_bytes == 0} == {0}
    back = pieces.decode(pieces.encode(edge_docs.where("doc_id < 12")), into="again").where("coalesce(text, '') <> again")
    assert back.count() == 0 and pieces.round_trips(no_docs).count() == 0


def test_unigram_segmentation_is_the_best_one():
    rng = random.Random(6)
    scores = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))): -rng.random() * 9 for _ in range(14)} | {"a": -5.0, "b": -6.0}
    lattice = pieces.Segmenter(scores, merges=False)

    def best(word):
        return 0.0 if not word else max(scores[word[:n]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in scores)

    for word in sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(60)}):
        found = lattice.segment(word)
        assert "".join(found) == word and sum(scores[p] for p in found) == pytest.approx(best(word))


def test_lm_scores_on_edges(edge_docs, no_docs):
    rows = lm_scores.score(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in rows)
    assert lm_scores.score(no_docs).count() == 0


def test_lm_scores_know_every_frequent_word(spark):
    """More words of five occurrences than a fixed vocabulary held: each pair is in five texts alike."""
    text = " ".join(f"w{i}" for i in range(66_000))
    rows = lm_scores.score(spark.createDataFrame([(i, text) for i in range(5)], "doc_id int, text string")).collect()
    assert [(r.n_words, r.backoff_share) for r in rows] == [(66_000, 0.0)] * 5
    assert all(abs(r.mean_log_score - math.log(4 / 5)) < 1e-9 for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, database, name):
    assert difference(registry.queries()[name](spark, SMALL).toPandas(), database.execute(registry.oracle_sql()[name]).df()) is None


def test_pipeline_matches_its_stages_by_brute_force(spark, database):
    import corpus_pipeline

    docs = {i: t for i, t in database.execute("SELECT doc_id, text FROM documents").fetchall()}
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    clean = corpus_pipeline.reject_toxic(spark, frame, SMALL)
    assert clean.columns == list(corpus_pipeline.COLUMNS)
    left = {r.doc_id: r.text for r in clean.collect()}
    assert set(left) <= set(docs) and len(left) > 0.8 * len(docs)
    texts = {}
    for i in sorted(left):
        texts.setdefault(re.sub(rb"[\x20\x09-\x0D]+", b" ", left[i].encode()), i)
    unique = corpus_pipeline.drop_copies(spark, clean, SMALL)
    assert {r.doc_id for r in unique.collect()} == set(texts.values())
    near = near_components([(i, left[i]) for i in texts.values()])
    single = corpus_pipeline.drop_near_copies(spark, unique, SMALL)
    assert {r.doc_id for r in single.collect()} == {i for i, (_, c) in near.items() if i == c}
    cut = corpus_pipeline.cut_repeats(spark, single, SMALL)
    assert cut.columns == list(corpus_pipeline.COLUMNS) and cut.count() <= single.count()
    result = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in result.select("doc_id").distinct().collect()} == {r.doc_id for r in cut.select("doc_id").collect()}
