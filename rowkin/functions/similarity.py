"""String similarity kernels, and one Arrow function that scores whole pairs.

The longest common subsequence is bit-parallel over whole numbers, so strings of any length
take a few machine steps a character. All scores of a pair come back in one struct: strings
cross to Python once. Equal pairs of strings in a batch are scored once, and many pairs at a
time where the shorter text has at most 64 characters; the plain functions of two texts say
what is meant, and do the rest.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    if a == b:
        return len(a)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = v = (1 << len(a)) - 1
    for c in b:
        u = v & where.get(c, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


@lru_cache(maxsize=200_000)
def ratio(a: str, b: str) -> float:
    """Share of the characters of both that a longest common subsequence takes, 0 to 100; two empty texts agree."""
    n = len(a) + len(b)
    return 200.0 * common(a, b) / n if n else 100.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """The best ratio of shared words, and of each side's words with the shared ones first; 100 if one side adds none."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (sorted(s) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 100.0
    one, two, shared = " ".join(both + left), " ".join(both + right), " ".join(both)
    return max([ratio(one, two), *((ratio(shared, one), ratio(shared, two)) if both else ())])


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter text with a window of the longer that is as long, or clipped at an end."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    if a in b:
        return 100.0
    best = max(ratio(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))
    return max(best, partial_turned(b, a)) if len(a) == len(b) else best


def partial_turned(a: str, b: str) -> float:
    return max(ratio(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised by 0.1 for each of up to four first letters in common where it exceeds 0.7; 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, first = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                first.append(c)
                break
    if not first:
        return 0.0
    m = len(first)
    moved = sum(x != y for x, y in zip(first, (c for c, t in zip(b, taken) if t))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    start = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + 0.1 * start * (1 - jaro) if jaro > 0.7 else jaro


def edits(a: str, b: str) -> tuple[int, int, int]:
    """Replacements, insertions and deletions of a shortest edit script from ``a`` to ``b``.

    A common start and end are matched; of the scripts for the rest, one with most replacements is taken.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    a, b = a[start:], b[start:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return 0, len(b), len(a)
    prev = [(j, 0, j, 0) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [(i, 0, 0, i)]
        for j, y in enumerate(b, 1):
            d, r, n, e = prev[j - 1]
            if x == y:
                row.append((d, r, n, e))
                continue
            d2, r2, n2, e2 = row[j - 1]
            d3, r3, n3, e3 = prev[j]
            row.append(min((d + 1, r + 1, n, e), (d2 + 1, r2, n2 + 1, e2), (d3 + 1, r3, n3, e3 + 1), key=lambda s: (s[0], -s[1])))
        prev = row
    return prev[-1][1:]


def token_best(a: str, b: str) -> tuple[float, float]:
    """For each word of ``a`` its best ratio (0 to 1) with a word of ``b``: the least and the mean; (0, 0) without words."""
    words = b.split()
    best = [max((ratio(u, v) / 100 for v in words), default=0.0) for u in a.split()]
    return (min(best), sum(best) / len(best)) if best else (0.0, 0.0)


#: Characters of the shorter text that the functions of many pairs take (bits of a number), those of the longer one, and pairs at a time.
BITS, LONGEST, AT_ONCE = 64, 256, 512


def _shapes(pairs: list[tuple[str, str]], most: int = BITS):
    """Places of pairs of like lengths, at most ``AT_ONCE``; and of those that are too long, or have an empty side, one by one."""
    fit, rest = [], []
    for i, (a, b) in enumerate(pairs):
        (fit if 0 < len(a) <= most and 0 < len(b) <= LONGEST else rest).append(i)
    fit.sort(key=lambda i: (len(pairs[i][0]), len(pairs[i][1])))
    return [np.array(fit[i : i + AT_ONCE]) for i in range(0, len(fit), AT_ONCE)], rest


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a text a row, and lengths."""
    longest = max(map(len, texts))
    return np.array(texts, f"<U{longest}").view("<u4").reshape(len(texts), longest), np.array([len(x) for x in texts])


def _masks(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """A row for each place of ``b``, a column for each pair: the places of ``a`` with the same character, as bits."""
    found = np.zeros((b.shape[1], len(b)), np.uint64)
    for i in range(a.shape[1]):
        found |= ((b.T == a[:, i]) & (na > i)).astype(np.uint64) << np.uint64(i)
    found[np.arange(b.shape[1])[:, None] >= nb] = 0
    return found


def _full(na: np.ndarray) -> np.ndarray:
    """As many bits set as the text has characters."""
    return np.uint64(2**64 - 1) >> (64 - na).astype(np.uint64)


def ratios(pairs: list[tuple[str, str]]) -> list[float]:
    """``ratio`` of many pairs."""
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    groups, rest = _shapes(pairs)
    out = np.empty(len(pairs))
    for i in rest:
        out[i] = ratio(*pairs[i])
    for at in groups:
        (a, na), (b, nb) = (_points([pairs[i][k] for i in at]) for k in (0, 1))
        full = v = _full(na)
        for mask in _masks(a, na, b, nb):
            u = v & mask
            v = v + u | v - u
        out[at] = 200.0 * (na - np.bitwise_count(v & full).astype(np.int64)) / (na + nb)
    return out.tolist()


def token_sorts(pairs: list[tuple[str, str]]) -> list[float]:
    """``token_sort`` of many pairs."""
    return ratios([(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) for a, b in pairs])


def token_sets(pairs: list[tuple[str, str]]) -> list[float]:
    """``token_set`` of many pairs."""
    out, asked, whose = [0.0] * len(pairs), [], []
    for i, (a, b) in enumerate(pairs):
        x, y = set(a.split()), set(b.split())
        if not x or not y:
            continue
        both, left, right = (sorted(s) for s in (x & y, x - y, y - x))
        if both and (not left or not right):
            out[i] = 100.0
            continue
        one, two, shared = " ".join(both + left), " ".join(both + right), " ".join(both)
        more = [(one, two), *([(shared, one), (shared, two)] if both else [])]
        asked += more
        whose += [i] * len(more)
    for i, r in zip(whose, ratios(asked)):
        out[i] = max(out[i], r)
    return out


def partials(pairs: list[tuple[str, str]]) -> list[float]:
    """``partial`` of many pairs: every window at once, a bit-parallel step a character."""
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    groups, rest = _shapes(pairs)
    out = np.empty(len(pairs))
    for i in rest:
        out[i] = partial(*pairs[i])
    for at in groups:
        sides = [_points([pairs[i][k] for i in at]) for k in (0, 1)]
        best = _windows(*sides[0], *sides[1])
        same = np.flatnonzero(sides[0][1] == sides[1][1])  # texts of one length: either may be the one with windows
        if len(same):
            best[same] = np.maximum(best[same], _windows(sides[1][0][same, :BITS], sides[1][1][same], sides[0][0][same], sides[0][1][same]))
        out[at] = best
    return out.tolist()


def _windows(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The best ratio of each ``a`` with a window of ``b`` that is as long, or clipped at an end."""
    size, long = int(na.max()), b.shape[1]
    # Window w begins at w - size + 1; beyond the ends nothing matches.
    padded = np.zeros((long + 2 * size, len(b)), np.uint64)
    padded[size - 1 : size - 1 + long] = _masks(a, na, b, nb)
    starts = np.arange(1 - size, long)[:, None]
    full = _full(na)
    v = np.repeat(full[None, :], len(starts), 0)
    for k in range(size):
        u = v & np.where(na > k, padded[k : k + len(starts)], np.uint64(0))
        v = v + u | v - u
    length = np.minimum(starts + na, nb) - np.maximum(starts, 0)
    score = 200.0 * (na - np.bitwise_count(v & full).astype(np.int64)) / (na + np.maximum(length, 0))
    return np.where(length > 0, score, 0.0).max(0)


def all_edits(pairs: list[tuple[str, str]]) -> list[tuple[int, int, int]]:
    """``edits`` of many pairs. A script's cost is its length, less a little for each replacement: the least one tells both, and
    the lengths of the texts tell how many more characters are inserted than deleted."""
    left = []
    for a, b in pairs:
        start = 0
        while start < min(len(a), len(b)) and a[start] == b[start]:
            start += 1
        end = 0
        while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
            end += 1
        left.append((a[start : len(a) - end], b[start : len(b) - end]))
    groups, rest = _shapes(left)
    out: list = [None] * len(pairs)
    for i in rest:
        out[i] = edits(*left[i])
    one = 1 << 12
    for at in groups:
        (a, na), (b, nb) = (_points([left[i][k] for i in at]) for k in (0, 1))
        cost = np.empty(len(at), np.int64)
        above = [np.full(len(at), j * one, np.int64) for j in range(b.shape[1] + 1)]
        for i in range(1, a.shape[1] + 1):
            row = [np.full(len(at), i * one, np.int64)]
            for j in range(1, b.shape[1] + 1):
                here = np.minimum(np.minimum(row[-1], above[j]) + one, above[j - 1] + one - 1)
                row.append(np.where(a[:, i - 1] == b[:, j - 1], above[j - 1], here))
            for k in np.flatnonzero(na == i):
                cost[k] = row[nb[k]][k]
            above = row
        length = -(-cost // one)
        replaced = length * one - cost
        inserted = (length - replaced + nb - na) // 2
        for i, *kinds in zip(at.tolist(), replaced.tolist(), inserted.tolist(), (length - replaced - inserted).tolist()):
            out[i] = tuple(kinds)
    return out


def jaro_winklers(pairs: list[tuple[str, str]]) -> list[float]:
    """``jaro_winkler`` of many pairs: each character of ``a`` in turn takes the first free place of ``b`` in reach that has it, as bits."""
    groups, rest = _shapes([(b, a) for a, b in pairs])
    out = np.empty(len(pairs))
    for i in rest:
        out[i] = jaro_winkler(*pairs[i])
    one = np.uint64(1)
    for at in groups:
        (a, na), (b, nb) = (_points([pairs[i][k] for i in at]) for k in (0, 1))
        reach = np.maximum(np.maximum(na, nb) // 2 - 1, 0)
        masks = _masks(b, nb, a, na)
        taken, met = np.zeros(len(at), np.uint64), np.zeros(a.shape, bool)
        for i in range(a.shape[1]):
            low, high = np.clip(i - reach, 0, BITS), np.minimum(i + reach + 1, nb)
            near = np.where(high > low, _full(np.maximum(high, 1)) & ~np.where(low > 0, _full(np.maximum(low, 1)), np.uint64(0)), np.uint64(0))
            free = masks[i] & near & ~taken
            first = free & (~free + one)
            taken |= first
            met[:, i] = first != 0
        used = (taken[:, None] >> np.arange(b.shape[1], dtype=np.uint64) & one).astype(bool)
        m = met.sum(1)
        in_order = lambda x, kept: np.take_along_axis(x, np.argsort(~kept, axis=1, kind="stable"), 1)
        x, y = in_order(a, met), in_order(b, used)
        both = min(x.shape[1], y.shape[1])
        moved = ((x[:, :both] != y[:, :both]) & (np.arange(both) < m[:, None])).sum(1) // 2
        n = np.maximum(m, 1)
        jaro = (m / na + m / nb + (m - moved) / n) / 3
        begin = min(4, both)
        same = (a[:, :begin] == b[:, :begin]) & (np.arange(begin) < np.minimum(na, nb)[:, None])
        start = np.logical_and.accumulate(same, 1).sum(1)
        score = np.where(jaro > 0.7, jaro + 0.1 * start * (1 - jaro), jaro)
        out[at] = np.where(m > 0, score, 0.0)
    out[[i for i, (a, b) in enumerate(pairs) if a == b]] = 1.0
    return out.tolist()


#: Functions of many pairs that say what those of one say.
MANY = {ratio: ratios, token_sort: token_sorts, token_set: token_sets, partial: partials, edits: all_edits, jaro_winkler: jaro_winklers}


def _each(f, a: pd.Series, b: pd.Series) -> list:
    """``f`` of each pair, once for pairs that repeat."""
    codes, pairs = pd.factorize(pd.Series(list(zip(a, b)), dtype=object))
    made = MANY[f](pairs) if f in MANY else [f(x, y) for x, y in pairs]
    return [made[i] for i in codes]


def _fields_each(asked: dict, sides: dict) -> dict[str, list]:
    """``_each`` of several scores, name: (kernel, field). Fields are scored together: a core is often the name."""
    out: dict[str, list] = {}
    for f in dict.fromkeys(f for f, _ in asked.values()):
        names = [k for k, (g, _) in asked.items() if g is f]
        made = _each(f, *(pd.concat([sides[asked[k][1]][side] for k in names]) for side in (0, 1)))
        n = len(made) // len(names)
        out |= {k: made[i * n : (i + 1) * n] for i, k in enumerate(names)}
    return out


def scorer(f):
    """An Arrow function of two string columns from a function of two texts."""

    @F.pandas_udf(DoubleType())
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(_each(f, a, b))

    return score


#: name: kernel, 0 to 100 but for Jaro-Winkler.
KERNELS = {"indel_ratio": ratio, "token_sort_ratio": token_sort, "token_set_ratio": token_set, "partial_ratio": partial, "jaro_winkler": jaro_winkler}

SCREEN_SCORES = ["name_ratio", "core_ratio", "core_sort", "core_set", "address_ratio", "address_sort", "address_set"]
FULL_SCORES = [
    "name_sort", "name_set", "name_partial", "name_jw", "core_partial", "core_jw", "address_partial", "address_jw",
    "compact_ratio", "compact_partial", "replaced", "inserted", "deleted", "worst_token", "mean_token",
]


def _struct(names: list[str]) -> StructType:
    return StructType([StructField(n, DoubleType()) for n in names])


#: Kernel and field of the scores of ``SCREEN_SCORES``.
_SCREEN_ONE = dict(zip(SCREEN_SCORES, ((ratio, "n"), (ratio, "c"), (token_sort, "c"), (token_set, "c"), (ratio, "a"), (token_sort, "a"), (token_set, "a"))))


@F.pandas_udf(_struct(SCREEN_SCORES))
def _screener(n1: pd.Series, c1: pd.Series, a1: pd.Series, n2: pd.Series, c2: pd.Series, a2: pd.Series) -> pd.DataFrame:
    made = _fields_each(_SCREEN_ONE, {"n": (n1, n2), "c": (c1, c2), "a": (a1, a2)})
    return pd.DataFrame({k: made[k] for k in SCREEN_SCORES}, dtype=np.float64)


#: Said not to be deterministic: else the gate, a filter on its scores, is moved before the dealing out to all tasks, and they are computed twice.
_screen = _screener.asNondeterministic()

#: Kernel and fields (name, core, address, compact core) of the scores of ``FULL_SCORES``; the last two give several.
_ONE = {
    "name_sort": (token_sort, "n"), "name_set": (token_set, "n"), "name_partial": (partial, "n"), "name_jw": (jaro_winkler, "n"), "core_partial": (partial, "c"), "core_jw": (jaro_winkler, "c"),
    "address_partial": (partial, "a"), "address_jw": (jaro_winkler, "a"), "compact_ratio": (ratio, "k"), "compact_partial": (partial, "k"),
}
_MORE = {("replaced", "inserted", "deleted"): (edits, "k"), ("worst_token", "mean_token"): (token_best, "c")}


@lru_cache
def _fuller(names: tuple[str, ...]):
    """An Arrow function of those of ``FULL_SCORES`` that are asked for; no other is computed."""

    @F.pandas_udf(_struct(list(names)))
    def full(n1: pd.Series, c1: pd.Series, a1: pd.Series, n2: pd.Series, c2: pd.Series, a2: pd.Series) -> pd.DataFrame:
        sides = {"n": (n1, n2), "c": (c1, c2), "a": (a1, a2), "k": tuple(c.str.replace(" ", "", regex=False) for c in (c1, c2))}
        made = _fields_each({k: of for k, of in _ONE.items() if k in names}, sides)
        for kinds, (f, x) in _MORE.items():
            if set(kinds) & set(names):
                made |= dict(zip(kinds, zip(*_each(f, *sides[x])) if len(n1) else [[]] * len(kinds)))
        return pd.DataFrame({k: made[k] for k in names}, dtype=np.float64)

    return full


def _fields() -> list[Column]:
    return [F.col(f"{side}.{f}") for side in ("x", "y") for f in ("name", "core", "address")]


def screen_scores() -> Column:
    """The scores the gate and the screening model need, of the record structs x and y."""
    return _screen(*_fields())


def full_scores(names: list[str] = FULL_SCORES) -> Column:
    """The further scores of the main model, or some of them."""
    return _fuller(tuple(names))(*_fields())


@F.pandas_udf(DoubleType())
def best_number_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The best ratio (0 to 1) of a number of one array with one of the other; 0 if either is empty."""
    return pd.Series([max((ratio(u, v) / 100 for u in x for v in y), default=0.0) for x, y in zip(a, b)], dtype=np.float64)


def register(spark) -> None:
    """The kernels as SQL functions."""
    for name, f in KERNELS.items():
        spark.udf.register(name, scorer(f))
