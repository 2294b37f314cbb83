"""The decoder against its whole lattice, and texts that are hard on patterns and decoders."""

import random
import time
from collections import Counter

import pytest

from gleaner.llm.toxicity import END, LEET, START, CharModel, Restorer, add_grams, decode

WORDS = "idiot kill still till ill hill lies list sell tell sit his hit".split()


@pytest.fixture(scope="module")
def model():
    counts: Counter = Counter()
    for n, word in enumerate(WORDS, 1):
        held: Counter = Counter()
        add_grams(held, word, n, 4)
        for gram, k in held.items():
            for width in range(1, 5):
                counts[gram[-width:]] += k
    return CharModel(counts, 4)


def readings(noisy, model):
    """Every way through the lattice: ``(text, score)``."""
    width = model.order - 1
    paths = [("", START, 0.0)]
    for at, c in enumerate(noisy):
        after = []
        for text, state, score in paths:
            step = lambda x, cost: after.append((text + x, (state + x)[-width:], score - cost + model.log_p(state, x)))
            repeats = at > 0 and noisy[at - 1] == c
            if c.isalpha():
                step(c, 0)
            else:
                for x in LEET.get(c, ""):
                    step(x, 0.7)
            if c.isdigit():
                after.append((text + c, (state + c)[-width:], score - 6.0))
            if repeats and (c.isalpha() or c.isdigit()):
                after.append((text, state, score - 1.0))
            if not c.isalpha() and not c.isdigit():
                after.append((text, state, score - (0.2 if c in " \t.-_*" else 2.5)))
                if state != START:
                    after.append((text + " ", START, score - 1.5 + model.log_p(state, END)))
        paths = after
    return [(text.strip(), score + (model.log_p(state, END) if state != START else 0.0)) for text, state, score in paths]


def test_decode_finds_the_likeliest_reading(model):
    rng = random.Random(4)
    for _ in range(400):
        noisy = "".join(rng.choice("1l!iskt70 .-_*+|hh5$") for _ in range(rng.randint(1, 7)))
        best = {}
        for text, score in readings(noisy, model):
            best[text] = max(score, best.get(text, float("-inf")))
        assert best[decode(noisy, model)] == pytest.approx(max(best.values()), abs=1e-9), noisy


def test_disguises(model):
    restore = Restorer(model)
    assert [restore(x) for x in ("1d10t", "k i l l", "h-i-l-l", "st1111ll", "1!$+")] == ["idiot", "kill", "hill", "still", "list"]


@pytest.mark.parametrize("text", [
    "_" * 100_000 + "x", "-" * 100_000 + "b", "*a" * 50_000, "a b " * 25_000, "abcdefgh" * 125_000, "a" * 1_000_000, "k1ll" * 10_000,
    " ".join(sign * n + "word" for sign in "_.-*" for n in range(50, 120)), "a_" * 50_000 + "word", "",
])
def test_hard_texts_take_seconds(model, text):
    started = time.perf_counter()
    Restorer(model).all_features(text)
    assert time.perf_counter() - started < 10
