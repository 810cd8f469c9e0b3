"""Guess costs against all segmentations; word hashes without algebraic collisions."""

from __future__ import annotations

import math
import random
import time

import numpy as np
import pytest

pytest.importorskip("dailytally.llm")
from dailytally.llm import minhash, secrets  # noqa: E402

RANKS = {"pass": 3, "word": 7, "password": 1, "abc": 40, "qwe": 60, "hahahaha": 2}


def span(value, i, j, ranks):
    """Least cost of value[i:j] as one span that isn't brute force, from the definition."""
    v, n, found = value[i:j], j - i, []
    low = v.lower() if len(value.lower()) == len(value) else v  # a few letters change length
    leet = low.translate(secrets.LEET)
    rank = ranks.get(low) or ranks.get(leet)
    if rank:
        found.append(math.log10(rank) + 0.5 * (low != v) + 0.5 * (leet != low))
    for unit in range(1, n // 2 + 1):
        if n % unit == 0 and low == low[:unit] * (n // unit) and (unit > 1 or n >= 3):
            found.append(sum(map(secrets.brute, v[:unit])) + math.log10(n // unit))
    if n >= 3 and all(low[k : k + 2] in secrets.walks() for k in range(n - 1)):
        found.append(math.log10(47) + math.log10(n))
    if secrets.DATE.fullmatch(v):
        found.append(math.log10(100 if n == 4 else 36500))
    return min(found, default=math.inf)


def exhaustive(value, ranks):
    cut, done = math.log10(2), [0.0]
    for j in range(1, len(value) + 1):
        done.append(min(done[i] + (cut if i else 0) + min(span(value, i, j, ranks), sum(map(secrets.brute, value[i:j]))) for i in range(j)))
    return done[-1]


def values():
    rng = random.Random(7)
    for alphabet in ("ab", "qw1", "aA*", "abc123", "passwordPASSW0RD$", "*", "haHA", "zxcvbn09", "12-/0"):
        for _ in range(120):
            yield "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 26)))
    for _ in range(150):  # repeats of any unit between other things
        unit = "".join(rng.choice("abcqwert1#Z") for _ in range(rng.randrange(1, 8)))
        yield rng.choice(["", "x", "pass", "2019"]) + unit * rng.randrange(2, 7) + rng.choice(["", unit[:1], "word", "1999-12-31"])
    yield from ("password2019", "p4ssw0rd" * 3, "hahahaha" * 4, "qwqwqwqwqw", "abcdabcdabce", "19991231" * 3, "ǰǰǰ", "İx" * 3, "K" * 5 + "k" * 5)


def test_costs_equal_all_segmentations():
    for v in values():
        want = exhaustive(v, RANKS)
        assert secrets.guess_cost(v, ranks=RANKS) == pytest.approx(want, abs=1e-9), v
        for enough in (3.0, 7.5, 10.0):
            got = secrets.guess_cost(v, enough, RANKS)
            assert got == pytest.approx(want, abs=1e-9) if want < enough - 1e-9 else got >= enough - 1e-9, (v, enough)


def test_masks_and_repeats_of_any_length_are_cheap():
    for n in (24, 72, 73, 500, 100_000):
        assert secrets.guess_cost("*" * n, 10.0) == pytest.approx(math.log10(33) + math.log10(n))
    assert secrets.guess_cost("abcde" * 8, 10.0) < 10  # a unit of five
    assert secrets.guess_cost("Zq3" * 100_000, 10.0) == pytest.approx(2 * math.log10(26) + 1 + 5)
    assert not secrets.scan("password: " + "*" * 80) and secrets.scan("password: !" + "xK9#vQ2!mZ7@pL4$" * 2)
    assert secrets.guess_cost("qwertyuiop" * 3 + "poiuytrewq" * 3, 10.0) < 10


def test_time_is_linear():
    def seconds(v):
        t = time.perf_counter()
        secrets.guess_cost(v, 10.0)
        return time.perf_counter() - t

    rng = random.Random(3)
    assert seconds("".join(rng.choice("abcdefgXYZ0189#!") for _ in range(1_000_000))) < 5  # certain after a few characters
    seconds("*" * 1000)
    short, long = seconds("*" * 20_000), seconds("*" * 200_000)
    assert long < 40 * short + 1


def hashes(*words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return minhash.word_hashes(data, np.array([0, len(data)]))[0]


def test_thue_morse_words_have_hashes_of_their_own():
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    got = hashes(word, other, word, "a" + word, word + "a")
    assert got[0] == got[2] and len(set(got.tolist())) == 4


def test_word_hashes_do_not_depend_on_where_words_stand():
    rng = random.Random(5)
    words = ["".join(rng.choice("abÀß9-") for _ in range(rng.choice([1, 2, 5, 63, 64, 65, 200]))) for _ in range(400)]
    got = {w: hashes(w)[0] for w in words}
    assert len(set(got.values())) == len(set(words))
    text = (" \n  " + "\t".join(words) + "  ").encode()
    both = np.frombuffer(text + text, np.uint8)
    h, n = minhash.word_hashes(both, np.array([0, len(text), 2 * len(text)]))
    assert n.tolist() == [400, 400] and h.tolist() == [int(got[w]) for w in words] * 2
    assert hashes("ABC")[0] == hashes("abc")[0] != hashes("acb")[0]
    empty = np.frombuffer(b"  \n", np.uint8)
    assert minhash.word_hashes(empty, np.array([0, 3]))[1].tolist() == [0]
