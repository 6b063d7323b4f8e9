"""Similarity of strings, 0 to 100, on the longest common subsequence.

These have no built-in form; they run as Arrow-batched functions and only on pairs inside of blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word step a character."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    return 100.0 * 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with any stretch of the longer one of its length, or cut off by an end."""
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    if not s:
        return 100.0 if not t else 0.0
    n = len(s)
    return max(ratio(s, t[max(0, i) : i + n]) for i in range(1 - n, len(t)) if i + n > 0)


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _sets(a: str, b: str) -> tuple[str, str, str]:
    x, y = set(a.split()), set(b.split())
    return " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))


def token_set_ratio(a: str, b: str) -> float:
    both, left, right = _sets(a, b)
    if not a.split() or not b.split():
        return 0.0
    if both and (not left or not right):
        return 100.0
    x, y = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max([ratio(x, y)] + ([ratio(both, x), ratio(both, y)] if both else []))


def weighted_ratio(a: str, b: str) -> float:
    """Best of plain, token and, for strings of very different length, partial ratios, each with its weight."""
    if not a or not b:
        return 0.0
    n = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if n < 1.5:
        return max(best, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if n < 8 else 0.6
    both, left, right = _sets(a, b)
    tokens = 100.0 if both else max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(left, right))
    return max(best, scale * partial_ratio(a, b), 0.95 * scale * tokens)


SCORERS: dict[str, Callable[[str, str], float]] = {"ratio": ratio, "partial_ratio": partial_ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio, "weighted_ratio": weighted_ratio}


def score(kind: str, a: Column, b: Column) -> Column:
    """Whole-number score; null where either is null. Called nondeterministic, though it is not: else a filter on the score is moved below
    the exchange that spreads its pairs, and scores them there, in few tasks, and once more above it."""
    fn = SCORERS[kind]

    @F.pandas_udf("int")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else int(fn(p, q)) for p, q in zip(x, y)], dtype="Int32")

    return run.asNondeterministic()(a, b)


# ---- many pairs at once --------------------------------------------------------------------------------------------

#: Characters of the shorter string of a pair that one machine word holds; pairs compared at once.
WORD, LOT = 64, 1 << 14


class Strings:
    """Distinct strings as numbers of their characters, and for each of up to WORD characters the places of every character as bits."""

    def __init__(self, strings: list[str]):
        self.size = np.array([len(s) for s in strings], np.int64)
        wide = max(1, int(self.size.max(initial=0)))
        points = np.frombuffer(np.array(strings, f"<U{wide}").tobytes(), np.uint32).reshape(len(strings), wide)
        there = np.arange(wide) < self.size[:, None]
        points = np.where(there, points.astype(np.int64) + 1, 0)  # 0 is no character
        number = np.zeros(int(points.max(initial=0)) + 1, np.int64)
        number[points] = 1
        number[0] = 0
        number = np.where(number > 0, np.cumsum(number), 0)
        self.letters = int(number.max()) + 1
        self.code = np.asfortranarray(number[points])
        self.row = np.arange(len(strings)) * self.letters
        self.bits = self._places(self.code)

    def _places(self, code: np.ndarray) -> np.ndarray:
        bits = np.zeros(len(code) * self.letters, np.uint64)
        for k in range(min(code.shape[1], WORD)):
            bits[self.row + code[:, k]] |= np.uint64(1 << k)
        bits[self.row] = 0
        return bits

    @cached_property
    def backward(self) -> np.ndarray:
        at = self.size[:, None] - 1 - np.arange(self.code.shape[1])
        return np.asfortranarray(np.where(at >= 0, np.take_along_axis(self.code, np.maximum(at, 0), 1), 0))

    @cached_property
    def mirrored(self) -> np.ndarray:
        return self._places(self.backward)


def _subsequences(s: Strings, i: np.ndarray, j: np.ndarray, low: int, high: int, mirrored: bool = False):
    """For places low to high of the strings j: (length read, longest common subsequence of each string i, of up to WORD characters, with what is read)."""
    bits, code = (s.mirrored, s.backward) if mirrored else (s.bits, s.code)
    row, v, columns = s.row[i], np.full(len(i), ~np.uint64(0)), code.T
    inside = np.where(s.size[i] < WORD, (np.uint64(1) << np.minimum(s.size[i], WORD - 1).astype(np.uint64)) - np.uint64(1), ~np.uint64(0))
    for k in range(low, high):
        u = v & bits[row + columns[k][j]]
        v = (v + u) | (v - u)
        yield k - low + 1, s.size[i] - np.bitwise_count(v & inside)


def _ratios(s: Strings, i: np.ndarray, j: np.ndarray, partial: bool) -> tuple[np.ndarray, np.ndarray]:
    """ratio and, if asked for, partial_ratio of pairs of strings, the shorter one's size up to WORD."""
    plain, part = np.full(len(i), 100.0), np.full(len(i), 100.0)
    swap = s.size[i] > s.size[j]
    short, long = np.where(swap, j, i), np.where(swap, i, j)
    n, m = s.size[short], s.size[long]
    plain[(n == 0) & (m > 0)] = part[(n == 0) & (m > 0)] = 0.0
    order = np.lexsort((-m, n))
    order = order[n[order] > 0]
    for size in np.unique(n[order]).tolist():
        group = order[n[order] == size]
        for at in range(0, len(group), LOT):
            lot = group[at : at + LOT]
            a, b, width = short[lot], long[lot], m[lot]
            best, most = np.zeros(len(lot)), int(width[0])
            for read, found in _subsequences(s, a, b, 0, most):
                if partial and read <= size:
                    np.maximum(best, 200.0 * found / (size + read), out=best)
            plain[lot] = 200.0 * found / (size + width)
            if partial:
                for read, found in _subsequences(s, a, b, 0, size, True):
                    np.maximum(best, 200.0 * found / (size + read), out=best)
                for start in range(1, most - size):  # whole stretches between the first and the last one, of the longer strings
                    k = int(np.searchsorted(-width, -(start + size)))
                    for _, found in _subsequences(s, a[:k], b[:k], start, start + size):
                        pass
                    np.maximum(best[:k], 200.0 * found / (2 * size), out=best[:k])
                part[lot] = best
    return plain, part


def _forms(strings: list[str], forms: list[str], i: np.ndarray, j: np.ndarray, known: np.ndarray, partial: bool = False) -> np.ndarray:
    """ratio or partial_ratio of the forms of strings; pairs whose forms are the strings themselves have it already."""
    other = np.array([a != b for a, b in zip(strings, forms)], bool)
    at, out = np.flatnonzero(other[i] | other[j]), known.copy()
    if len(at):
        number = {x: k for k, x in enumerate(dict.fromkeys(forms))}
        which = np.array([number[x] for x in forms])
        out[at] = _ratios(Strings(list(number)), which[i[at]], which[j[at]], partial)[int(partial)]
    return out


def _shared(tokens: list[set[str]], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs have a token in common."""
    held = Counter(t for x in tokens for t in x)
    some = np.array([any(held[t] > 1 for t in x) for x in tokens], bool)
    out = some[i] & some[j]
    at = np.flatnonzero(out)
    out[at] = np.fromiter((not tokens[a].isdisjoint(tokens[b]) for a, b in zip(i[at].tolist(), j[at].tolist())), bool, len(at))
    return out


def _token_sets(sets: list[set[str]], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """token_set_ratio of pairs that have a token in common: what both begin with counts whole, only the rests are compared."""
    out = np.full(len(i), 100.0)
    ids: dict[str, int] = {}
    at, left, right, both = [], [], [], []
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = sets[a], sets[b]
        common = x & y
        if len(common) < len(x) and len(common) < len(y):
            at.append(k)
            both.append(sum(map(len, common)) + len(common) - 1)
            left.append(ids.setdefault(" ".join(sorted(x - common)), len(ids)))
            right.append(ids.setdefault(" ".join(sorted(y - common)), len(ids)))
    if at:
        s, u, v, c = Strings(list(ids)), np.array(left), np.array(right), np.array(both)
        rest = np.zeros(len(at), np.int64)
        swap = s.size[u] > s.size[v]
        short, long = np.where(swap, v, u), np.where(swap, u, v)
        order = np.argsort(s.size[long], kind="stable")
        for low in range(0, len(order), LOT):
            lot = order[low : low + LOT]
            for _, found in _subsequences(s, short[lot], long[lot], 0, int(s.size[long[lot[-1]]])):
                pass
            rest[lot] = found
        x, y = c + 1 + s.size[u], c + 1 + s.size[v]
        out[at] = np.maximum(200.0 * (c + 1 + rest) / (x + y), np.maximum(200.0 * c / (c + x), 200.0 * c / (c + y)))
    return out


def many_scores(strings: list[str], i: np.ndarray, j: np.ndarray, kinds: tuple[str, ...] = tuple(SCORERS)) -> dict[str, np.ndarray]:
    """Whole-number scores of the pairs (strings[i], strings[j]), as ``score`` gives them, many pairs a step; strings are distinct.

    Pairs of which both strings are longer than WORD characters are scored one by one.
    """
    size = np.array([len(x) for x in strings], np.int64)
    quick = np.minimum(size[i], size[j]) <= WORD
    out = {k: np.zeros(len(i), np.int32) for k in kinds}
    for at in np.flatnonzero(~quick).tolist():
        for k in kinds:
            out[k][at] = int(SCORERS[k](strings[i[at]], strings[j[at]]))
    i, j = i[quick], j[quick]
    if not len(i):
        return out
    n, m = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    far = (n > 0) & (m / np.maximum(n, 1) >= 1.5)
    weighs, found, made = "weighted_ratio" in kinds, {}, Strings(strings)
    plain, part = found["ratio"], found["partial_ratio"] = _ratios(made, i, j, "partial_ratio" in kinds)
    if weighs or {"token_sort_ratio", "token_set_ratio"} & set(kinds):
        tokens = [x.split() for x in strings]
        bags = [set(x) for x in tokens]
        shared, ordered, as_set = _shared(bags, i, j), [" ".join(sorted(x)) for x in tokens], [" ".join(sorted(x)) for x in bags]
        by_order = found["token_sort_ratio"] = _forms(strings, ordered, i, j, plain)
        some = np.array([bool(x) for x in tokens], bool)
        sets = found["token_set_ratio"] = np.where(some[i] & some[j], _forms(ordered, as_set, i, j, by_order), 0.0)
        sets[shared] = _token_sets(bags, i[shared], j[shared])
        best = np.where(n == 0, 0.0, np.maximum(plain, 0.95 * np.maximum(by_order, sets)))
        at = np.flatnonzero(far)
        if weighs and len(at):
            u, v, lone = i[at], j[at], ~shared[at]
            parts = part[at] if "partial_ratio" in kinds else _ratios(made, u, v, True)[1]
            told, scale = np.full(len(at), 100.0), np.where(m[at] / n[at] < 8, 0.9, 0.6)
            a, b = u[lone], v[lone]
            ordered_parts = _forms(strings, ordered, a, b, parts[lone], True)
            told[lone] = np.maximum(ordered_parts, _forms(ordered, as_set, a, b, ordered_parts, True))
            best[at] = np.maximum(plain[at], np.maximum(scale * parts, 0.95 * scale * told))
        found["weighted_ratio"] = best
    for k in kinds:
        out[k][quick] = found[k].astype(np.int32)
    return out
