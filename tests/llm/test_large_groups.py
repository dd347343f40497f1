"""Rows made for very large groups, and passages that the pipeline cuts."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from conftest import SMALL

from tripmill.llm import jaccard_join, suffix_dedup


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(words))


def stored_rows(module, monkeypatch) -> dict[str, list]:
    """The frames that the module settles, by purpose."""
    frames, settle = {}, module.settle

    def kept(df, purpose):
        frames.setdefault(purpose, []).append(settle(df, purpose))
        return frames[purpose][-1]

    monkeypatch.setattr(module, "settle", kept)
    return frames


def test_a_pattern_within_a_text_makes_few_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    frames = stored_rows(suffix_dedup, monkeypatch)
    pattern = prose(random.Random(3), 3) + " "
    rows = [(i, prose(random.Random(i), 20) + " " + pattern * (300 + i)) for i in range(4)]
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.removal_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    windows = Counter(text[p : p + 400] for _, text in rows for p in range(len(text) - 399))
    for i, text in rows:
        spans = suffix_dedup.merged_spans([(p, p + 400) for p in range(len(text) - 399) if windows[text[p : p + 400]] > 1])
        assert found[i] == (sum(high - low for low, high in spans), len(spans)) and spans
    assert 0 < sum(frame.count() for frame in frames["hot-pieces"]) < 300


def test_a_group_of_near_copies_verifies_few_pairs(spark, monkeypatch):
    rng = random.Random(5)
    words = prose(rng, 150).split()
    rows = []
    for i in range(300):
        own = list(words)
        for at in rng.sample(range(150), rng.choice((1, 2, 2))):
            own[at] = f"own{i}"
        rows.append((i, " ".join(own)))
    pairs, verified = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda chosen, texts: pairs.append(chosen.count()) or verified(chosen, texts))
    found = {r.doc_id: r.component_id for r in jaccard_join.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    sets = {i: {tuple(t.split()[p : p + 5]) for p in range(146)} for i, t in rows}
    component = {i: i for i, _ in rows}
    for i in component:
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= 80 * (len(sets[i] | sets[j])) and component[i] != component[j]:
                low, high = sorted((component[i], component[j]))
                component = {k: low if c == high else c for k, c in component.items()}
    assert found == component
    assert sum(pairs) < 8 * len(rows)


def test_a_passage_spread_over_tasks_makes_no_long_lists(spark, monkeypatch):
    frames = stored_rows(jaccard_join, monkeypatch)
    passage = prose(random.Random(8), 60)
    rows = [(i, f"{prose(random.Random(100 + i), 160)} {passage}") for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(3)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 100), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.near_groups(docs).collect()}
    assert found == {i: i % 1000 for i, _ in rows}
    assert frames["long-lists"][0].count() < 20


def test_pairs_of_a_group_are_met_about_once(spark, monkeypatch):
    rng = random.Random(9)
    words = prose(rng, 150).split()
    rows = []
    for i in range(150):
        own = list(words)
        for at in rng.sample(range(150), rng.choice((2, 2, 3))):
            own[at] = f"own{i}"
        rows.append((i, " ".join(own)))
    kept, met_across = [], jaccard_join._met_across
    monkeypatch.setattr(jaccard_join, "_met_across", lambda *frames: kept.append((frames, met_across(*frames))) or kept[-1][1])
    monkeypatch.setattr(jaccard_join, "ROUNDS", 0)
    jaccard_join.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    (mixed, _, texts), met = kept[0]
    texts = {r.cid: r for r in texts.collect()}
    lists: dict[int, list] = {}
    for r in mixed.collect():
        lists.setdefault(r.token, []).append(r)
    wanted = Counter()
    for members in lists.values():
        for n, x in enumerate(members):
            for y in members[:n]:
                left, right = texts[x.cid], texts[y.cid]
                differ = sum(((left[f"m{i}"] ^ right[f"m{i}"]) & (2**64 - 1)).bit_count() for i in range(jaccard_join.MARKS))
                if x.component != y.component and 9 * differ <= left["size"] + right["size"] and 5 * min(left["size"], right["size"]) >= 4 * max(left["size"], right["size"]):
                    wanted[min(x.cid, y.cid), max(x.cid, y.cid)] += 1
    rows = [(r.a, r.b) for r in met.collect()]
    assert set(rows) == set(wanted) and len(wanted) > 100
    assert sum(wanted.values()) > 10 * len(wanted) and len(rows) < 2 * len(wanted)


def test_the_pipeline_cuts_passages_of_over_fifty_words(spark):
    rng = random.Random(6)
    passages = [" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 6))) for _ in range(n)) for n in (52, 55, 59)]
    assert all(256 < len(p) < 400 and len(p.split()) > 50 for p in passages)
    rows = [(i, f"{prose(rng, 80)} {i}{passages[i % 3]}{i} {prose(rng, 80)}") for i in range(9)]
    rows += [(20 + i, prose(rng, 150)) for i in range(4)]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    cut = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeats(spark, docs, SMALL).collect()}
    for i, text in rows:
        wanted = text.replace(passages[i % 3], "") if 3 <= i < 9 else text
        assert cut[i] == (wanted, len(wanted))
