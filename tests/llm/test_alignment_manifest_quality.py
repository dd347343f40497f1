"""Rule ensembles, tokenizer alignment and the Merkle manifest: brute force, edge rows, held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmill.llm import merkle_manifest as merkle
from tripmill.llm import quality_rules as quality
from tripmill.llm import tokenizer_alignment as alignment
from tripmill.llm.common import table, third

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, score string, n_a string, leaf string, _at string"
ODD_TEXTS = (
    None, "", " ", "\n", "a", "plain words here", "two  spaces", " leading", "trailing ", "tab\there", "line\nend", "line\n\nend", "end\n", "a \nb",
    "mark▁inside", "<|endoftext|> <s> </s> <unk> <0x41>", "I'll we've it's DON'T", "漢字 kanji 🎉🎉 Ω", "é é ﬁ ½ Å", "non\xa0break", "nul\x00byte",
    "aaaaaaaaaaaaaaa " * 30, "z" * 5000, "word " * 20_000, "ÀÉß ñandú çà Straße", "1234567 3.14 1,000", "　wide", "x᠎y", "soft­hyphen", "\r\nwindows\r\n",
)


@pytest.fixture(scope="module")
def edge_docs(spark):
    rows = [(i, t, ("en", "de", None, "zß")[i % 4], None if i % 5 == 0 else f"s{i}", None if i % 3 else i, i, "x", "y", "z", "w") for i, t in enumerate(ODD_TEXTS)]
    again = [rows[5], rows[5], (None, "no id", None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None), (7, "same id, other text", "zß", "s", 3, 1, "", "", "", "")]
    return spark.createDataFrame([*rows, *again], SCHEMA)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


# --- alignment


def aligned_by_hand(texts):
    """The contract's numbers by comparing byte ranges of all tokens."""
    own = alignment.aligner(public_tokenizers.path(alignment.VOCABULARY_A), public_tokenizers.path(alignment.MODEL_B))
    first = Tokenizer.from_file(public_tokenizers.path(alignment.VOCABULARY_A))
    first.encode_special_tokens = True

    def ranges(ids, names):
        ends = np.cumsum([len(names[i]) for i in ids]).tolist()
        return [(end - len(names[i]), end, i) for i, end in zip(ids, ends)]

    rows, held = [], Counter()
    for text in texts:
        a = ranges(first.encode(f" {text}", add_special_tokens=False).ids, own.names_a) if text else []
        b = ranges(own.model.encode(text), own.names_b) if text else []
        raw = f" {text}".encode()
        if any(b"".join(names[i] for _, _, i in side) != raw for side, names in ((a, own.names_a), (b, own.names_b))):
            a = b = []
        links, low = Counter(), 0
        for start, end, i in a:
            while b[low][1] <= start:
                low += 1
            at = low
            while at < len(b) and b[at][0] < end:
                links[i, b[at][2]] += 1
                at += 1
        groups, before = [], 0
        for end in sorted({x[1] for x in a} & {x[1] for x in b}):
            groups.append("|".join(",".join(str(i) for s, e, i in side if before <= s and e <= end) for side in (a, b)))
            before = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        rows.append((len(a), len(b), len(groups), sum(links.values()), links, digest))
        held.update(links.keys())
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return [
        (*row[:4], sum(n for pair, n in row[4].items() if held[pair] == best[pair[0]]), sum(n * held[pair] for pair, n in row[4].items()), row[5])
        for row in rows
    ]


@pytest.mark.parametrize("frequent", [0, 7, alignment.FREQUENT])
def test_alignment_equals_comparing_all_ranges(spark, edge_docs, frequent):
    rng = random.Random(5)
    letters = "aeinst bcd\nEÉ漢'’.,1 "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(150)]
    source = [(r.doc_id, r.text) for r in edge_docs.where("length(text) < 1000 or text is null").collect()] + [(1000 + i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(source, "doc_id bigint, text string").repartition(3)
    found = alignment.align_tokens(frame, frequent=frequent)
    assert found.columns == ["doc_id", *alignment.RESULTS]
    expected = [(i, *row) for (i, _), row in zip(source, aligned_by_hand([t for _, t in source]))]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, found.collect()), key=order) == sorted(expected, key=order)


def test_alignment_does_not_depend_on_stored_words(edge_docs):
    paths = public_tokenizers.path(alignment.VOCABULARY_A), public_tokenizers.path(alignment.MODEL_B)
    fresh, used = alignment.Aligner(*paths), alignment.Aligner(*paths)
    for text in (t for t in ODD_TEXTS if t):
        used.align(text)
        used.weight = alignment.KEPT_BYTES + 1  # the next text begins another generation
        fresh.young, fresh.old = {}, {}
        one, two = fresh.align(text), used.align(text)
        assert one[:4] == two[:4] and one[4].tolist() == two[4].tolist()


def test_identity_map_prefers_whole_pieces():
    assert alignment.identity_map([b"a", b"ab", b"", b"x"], [b"a", b"", b"a", b"ab"], [True, False, False, False]).tolist() == [2, 3, -1, -1]


def test_alignment_on_edges(edge_docs, no_docs):
    rows = alignment.align_tokens(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all((r.n_a, r.n_links, r.groups_sha256) == (0, 0, "") for r in rows if r.doc_id in (0, 1, 14))
    assert "score" in rows[0].asDict() and "text" not in rows[0].asDict() and rows[0]["n_a"] is not None
    assert alignment.align_tokens(no_docs).collect() == []


# --- manifest


def fields_digest(row, text=None):
    values = (row.doc_id, row.source, row.lang, row.n_chars, row.text if text is None else text)
    return merkle.digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([merkle.digest(levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, index):
    for nodes in levels[:-1]:
        first = index // 8 * 8
        yield "".join(nodes[first:index]), "".join(nodes[index + 1 : first + 8])
        index //= 8


def proved_by_hand(rows):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row.lang].append((row.doc_id is not None, row.doc_id or 0, fields_digest(row), row))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: r[:3])
        trees[lang] = tree_of([r[2] for r in by_lang[lang]])
    top = tree_of([trees[lang][-1][0] for lang in langs])
    lower, found = str.maketrans(merkle.UPPER, merkle.LOWER), []
    for place, lang in enumerate(langs):
        for index, (_, _, leaf, row) in enumerate(by_lang[lang]):
            steps = [*siblings(trees[lang], index), *siblings(top, place)]
            hit = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0 and row.text is not None
            folded = merkle.fold(fields_digest(row, row.text.translate(lower)) if hit else leaf, steps)
            found.append((row.doc_id, leaf, trees[lang][-1][0], top[-1][0], merkle.digest(x for s in steps for x in s), folded, folded == top[-1][0]))
    return found


def by_all(rows):
    return sorted(map(tuple, rows), key=repr)


def test_manifest_equals_hashing_by_hand(spark, edge_docs):
    docs = table(spark, SMALL, "documents")
    assert by_all(merkle.op13_merkle_manifest(spark, SMALL).collect()) == by_all(proved_by_hand(docs.collect()))
    rows = merkle.prove(merkle.build(edge_docs)).collect()
    assert by_all(rows) == by_all(proved_by_hand(edge_docs.collect()))
    assert not all(r.verified for r in rows) and any(r.verified for r in rows)


def test_manifest_over_blocks_and_subsets(spark):
    many = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"), F.when(F.col("id") % 900 > 0, "en").otherwise(F.concat(F.lit("l"), F.col("id"))).alias("lang"),
        F.lit("s").alias("source"), F.lit(7).cast("long").alias("n_chars"),
    )
    manifest, expected = merkle.build(many), proved_by_hand(many.collect())
    assert by_all(merkle.prove(manifest).collect()) == by_all(expected)
    assert manifest.root() == expected[0][3]
    wanted = spark.createDataFrame([(i,) for i in (3, 4, 4, 900, 5555, 8999, 123_456)], "doc_id bigint")
    some = merkle.prove(manifest, wanted, with_proofs=True).collect()
    assert by_all(r[:7] for r in some) == by_all(r for r in expected if r[0] in (3, 4, 900, 5555, 8999))
    assert all(merkle.digest(r.proof) == r.proof_sha256 for r in some)


def test_missing_nodes_are_the_fewest():
    for n, indices in ((1, [0]), (8, [0]), (9, [8]), (64, [0, 1, 9]), (70, [5, 64, 69]), (600, [*range(64)]), (513, [512])):
        found = merkle.missing(np.array(indices), n)
        known, sizes, level = set(indices), n, 0
        expected = []
        while sizes > 1:
            runs = {i // 8 for i in known}
            expected += [(level, i) for i in range(sizes) if i // 8 in runs and i not in known]
            known, sizes, level = runs, -(-sizes // 8), level + 1
        assert sorted(found) == expected


def test_manifest_of_nothing(no_docs):
    manifest = merkle.build(no_docs)
    assert manifest.root() is None and merkle.prove(manifest).collect() == []


# --- quality


@pytest.fixture(scope="module")
def model(spark):
    return quality.learn_from_tables(spark, SMALL.replace("0.001", "0.01"))


def test_quality_held_out(spark, model):
    folder = SMALL.replace("0.001", "0.01")
    scored = quality.op11_quality_rules(spark, folder)
    assert scored.count() == table(spark, folder, "documents").count()
    rows = scored.where("held_out").join(table(spark, folder, "labels"), "doc_id").collect()
    right = Counter((r.quality, r.predicted == r.quality) for r in rows)
    assert right[0, True] >= 0.95 * (right[0, True] + right[0, False]) and right[1, True] >= 0.97 * (right[1, True] + right[1, False])
    assert model.rules and len(model.rules) < 100


def test_rules_as_columns_equal_rules_by_hand(spark, model, edge_docs):
    docs = edge_docs.select("doc_id", "text").unionByName(table(spark, SMALL, "documents").select("doc_id", "text"))
    for row in quality.with_statistics(docs).withColumn("score", model.column()).collect():
        total = model.constant + sum(weight for rule, weight in model.rules if rule.holds(row.asDict()))
        assert row.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


def test_rules_are_read_from_printed_trees():
    printed = """RandomForestClassificationModel: uid=x, numTrees=2
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 1 <= 0.25)
      Predict: 0.0
     Else (feature 1 > 0.25)
      Predict: 1.0
    Else (feature 0 > 1.5)
     If (feature 0 <= 2.5E-1)
      Predict: 0.0
     Else (feature 0 > 2.5E-1)
      Predict: 1.0
  Tree 1 (weight 1.0):
    Predict: 1.0
"""
    a, b, inf = quality.STATISTICS[0], quality.STATISTICS[1], math.inf
    assert [r.intervals for r in quality.tree_rules(printed)] == [
        ((a, (-inf, 1.5)),), ((a, (-inf, 1.5)), (b, (-inf, 0.25))), ((a, (-inf, 1.5)), (b, (0.25, inf))), ((a, (1.5, inf)),), ((a, (1.5, 0.25)),),
    ]


def test_statistics_of_a_text(spark):
    row = quality.with_statistics(spark.createDataFrame([("One TWO two.\nA  -- b!!",)], "text string")).first()
    assert row.log_words == pytest.approx(math.log(7)) and row.line_words == 3 and row.ended_lines == 1.0
    assert row.distinct_words == 1.0 and row.sign_word_share == pytest.approx(1 / 6)
    assert row.upper_share == pytest.approx(5 / 11)
    blank = quality.with_statistics(spark.createDataFrame([(None,), ("",), (" \n",)], "text string")).collect()
    assert all(set(r[1:]) == {0.0} for r in blank)


def test_quality_on_edges(spark, model, edge_docs, no_docs):
    rows = quality.score(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert quality.score(no_docs, model).collect() == []
    labels = lambda *rows: spark.createDataFrame(list(rows), "doc_id bigint, quality int")
    rate = lambda *rows: quality.learn(edge_docs, labels(*rows))
    assert rate().constant == 0 and rate((1, 1), (2, None), (None, 0)).constant > 30 and rate((1, 0), (2, 0)).constant < -30
    assert rate((5, 1), (5, 0), (4, 1)).constant > 30  # an id with both labels is left out
    assert rate((5, 1), (99_999, 0)).constant > 30  # a label without a document
    assert not quality.learn(no_docs, labels((1, 0), (2, 1))).rules
    both = quality.score(edge_docs.where("doc_id = 5"), rate(*[(i, i % 2) for i in range(20)])).collect()
    assert len({r.score for r in both}) == 1


def test_held_out_rows_are_not_learned_from(spark):
    """Labels of held-out rows turned around leave the model as it is."""
    documents, labels = table(spark, SMALL, "documents").select("doc_id", "text"), table(spark, SMALL, "labels").select("doc_id", "quality")
    turned = labels.withColumn("quality", F.when(third() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.learn(documents, labels.where(third() != 1)) == quality.learn(documents, turned.where(third() != 1))
