import random

from tripmill.llm import pieces


def test_fallback_steps_are_taken_once(monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choice("aeiouthns") for _ in range(12)) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(60)]
    coder, small = (pieces.PieceCoder(pieces.model_path()) for _ in range(2))
    taken, step = [], coder.segmenter.suffixes.step
    monkeypatch.setattr(coder.segmenter.suffixes, "step", lambda state, symbol: taken.append((state, symbol)) or step(state, symbol))
    found = [a.tolist() for i in range(0, 60, 4) for a in coder.encode(texts[i : i + 4])]
    assert len(taken) == len(set(taken)) > 0
    monkeypatch.setattr(pieces, "KEPT_STEPS", 5)
    assert found == [a.tolist() for i in range(0, 60, 6) for a in small.encode(texts[i : i + 6])]
    assert all(coder.decode(ids) == text for ids, text in zip(found, texts))
