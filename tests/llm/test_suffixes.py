import random

import pytest

from tripmill.llm import pieces, token_counts
from tripmill.llm.suffixes import Recent, Suffixes


def test_automaton_finds_every_entry_that_ends_at_each_place():
    rng = random.Random(4)
    draw = lambda most: "".join(rng.choice("abé") for _ in range(rng.randint(1, most)))
    entries = sorted({draw(5) for _ in range(60)})
    automaton = Suffixes([[*map(ord, entry)] for entry in entries])
    for word in (draw(30) for _ in range(200)):
        state = 0
        for end in range(1, len(word) + 1):
            state = automaton.step(state, ord(word[end - 1]))
            wanted = sorted((e for e in entries if word[:end].endswith(e)), key=len, reverse=True)
            assert [entries[i] for i in automaton.ends[state]] == wanted
    assert Suffixes([]).step(0, 7) == 0


def test_words_in_steady_use_stay_and_others_go():
    store = Recent(limit=1000)
    for turn in range(20):
        store.turn()
        for key in store.missing(["kept", *(f"w{turn}-{i}" for i in range(5))]):
            assert key != "kept" or turn == 0
            store.keep(key, 1)
        assert store.find(["kept", "never"]) == [1, None]
    assert len(store.young) + len(store.old) < 20


@pytest.mark.parametrize("limit", [0, 2000])
def test_results_do_not_depend_on_what_is_kept(limit):
    rng = random.Random(8)
    parts = ["the", "there", "1,234", "naïve", "日本", "\n", "  ", "a\tb", "it's", "<|endoftext|>", "z" * 90]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(120)]
    whole, small = (token_counts.PrefixCounter(token_counts.vocabulary_path()) for _ in range(2))
    coder, tight = (pieces.PieceCoder(pieces.model_path()) for _ in range(2))
    small.counts.limit = tight.known.limit = limit
    for i in range(0, 120, 8):
        own = texts[i : i + 8]
        assert [small.count_and_fit(t, 9, p) for t, p in zip(own, small.prepare(own))] == [whole.count_and_fit(t, 9) for t in own]
        assert [a.tolist() for a in tight.encode(own)] == [coder.encode([t])[0].tolist() for t in own]
