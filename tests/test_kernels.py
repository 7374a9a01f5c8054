"""Kernels against plain definitions, on random strings."""

import random

import pandas as pd
import pytest

from rowkin.functions import similarity as s


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(prev[j] + 1 if x == y else max(prev[j + 1], row[j]))
        prev = row
    return prev[-1]


def texts(n=300, alphabet="ab c1", size=12, seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(alphabet) for _ in range(r.randint(0, size)))
    return [(word(), word()) for _ in range(n)]


def test_common_subsequence_and_ratio():
    for a, b in texts() + texts(20, "abcde", 200, 2):
        assert s.common(a, b) == lcs(a, b)
        assert s.ratio(a, b) == pytest.approx(200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100)
        assert s.ratio(a, b) == s.ratio(b, a)


def test_token_scores():
    assert s.token_sort("b a", "a b") == 100
    assert s.token_set("a b", "b a c") == 100
    assert s.token_set("", "a") == 0 and s.token_set("a", "b") == 0
    assert s.token_set("x a", "x b") == pytest.approx(max(s.ratio("x a", "x b"), s.ratio("x", "x a"), s.ratio("x", "x b")))
    for a, b in texts():
        assert s.token_set(a, b) == s.token_set(b, a) and 0 <= s.token_set(a, b) <= 100


def test_partial():
    assert s.partial("abc", "xxabcxx") == 100
    assert s.partial("", "") == 100 and s.partial("", "a") == 0
    for a, b in texts(100):
        x, y = sorted((a, b), key=len)
        if x and len(x) < len(y):
            assert s.partial(a, b) == max(s.ratio(x, y[max(0, i) : i + len(x)]) for i in range(1 - len(x), len(y)))


def test_jaro_winkler_known_values():
    assert s.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert s.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.813333, abs=1e-6)
    assert s.jaro_winkler("", "") == 1 and s.jaro_winkler("a", "") == 0


def test_edits_sum_to_the_distance():
    assert s.edits("ab", "ba") == (2, 0, 0)
    for a, b in texts(200):
        r, i, d = s.edits(a, b)
        prev = list(range(len(b) + 1))
        for n, x in enumerate(a, 1):
            row = [n]
            for j, y in enumerate(b):
                row.append(min(prev[j] + (x != y), prev[j + 1] + 1, row[j] + 1))
            prev = row
        assert r + i + d == prev[-1] and i - d == len(b) - len(a)


def test_token_best():
    assert s.token_best("", "a") == (0, 0) and s.token_best("a", "") == (0, 0)
    assert s.token_best("acme beta", "acme") == (pytest.approx(s.ratio("beta", "acme") / 100), pytest.approx((1 + s.ratio("beta", "acme") / 100) / 2))


@pytest.mark.parametrize("kernel", list(s.MANY))
def test_many_pairs_are_scored_like_one(kernel):
    pairs = texts(200) + texts(60, "abcd é", 70, 2) + texts(20, "ab", 300, 3) + [("a" * 63, "a" * 63 + "b"), ("a" * 64, "b" * 64), ("ab" * 32, "ba" * 32), ("", "")]
    assert s.MANY[kernel](pairs) == [kernel(a, b) for a, b in pairs] and s.MANY[kernel]([]) == []


def test_fields_that_say_the_same_are_scored_once(monkeypatch):
    """A core that is the name is not scored again, and Jaro-Winkler is said of many pairs at a time."""
    seen, asked = [], {"name_jw": (s.jaro_winkler, "n"), "core_partial": (s.partial, "c"), "core_jw": (s.jaro_winkler, "c"), "name_partial": (s.partial, "n")}
    for f in (s.jaro_winkler, s.partial):
        monkeypatch.setitem(s.MANY, f, lambda pairs, real=s.MANY[f]: seen.append(len(pairs)) or real(pairs))
    name, core = (pd.Series(["acme one", "beta", "acme one"]), pd.Series(["acme", "bet", "acne"])), (pd.Series(["acme one", "beta", "acme"]), pd.Series(["acme", "bet", "acne"]))
    made = s._fields_each(asked, {"n": name, "c": core})
    assert seen == [4, 4] and {k: list(v) for k, v in made.items()} == {k: [f(*p) for p in zip(*{"n": name, "c": core}[x])] for k, (f, x) in asked.items()}
