"""Pair similarities. Set and edit measures are built-in expressions; the fuzzy ratios are Arrow-batched UDFs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def ratio(a: Column, b: Column) -> Column:
    """min / max, 0 if either is 0."""
    return F.when((a == 0) | (b == 0), 0.0).otherwise(F.least(a, b) / F.greatest(a, b))


def equal(a: Column, b: Column) -> Column:
    """1 for equal texts that aren't empty."""
    return ((a != "") & (a == b)).cast("int")


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance / longer length in code points; 0 if either is empty."""
    return F.when((a == "") | (b == ""), 0.0).otherwise(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    n = F.size(F.array_union(a, b))
    return F.when(n == 0, 0.0).otherwise(overlap(a, b) / n)


def containment(a: Column, b: Column) -> Column:
    n = F.least(F.size(a), F.size(b))
    return F.when(n == 0, 0.0).otherwise(overlap(a, b) / n)


def numbers(a: Column, b: Column) -> dict[str, Column]:
    both, common = (F.size(a) > 0) & (F.size(b) > 0), overlap(a, b)
    same = F.array_sort(a) == F.array_sort(b)
    return {"both_present": both.cast("int"), "equal": (both & same).cast("int"), "overlap": common, "conflict": (both & (common == 0)).cast("int"), "disagree": (both & ~same).cast("int"), "jaccard": jaccard(a, b)}


def acronym_matches(a_acronym: Column, a_name: Column, b_acronym: Column, b_name: Column) -> Column:
    """One side's acronym, of two letters or more, is the other's name without spaces."""
    one = lambda acr, name: (F.length(acr) > 1) & (acr == F.replace(name, F.lit(" "), F.lit("")))
    return (one(a_acronym, b_name) | one(b_acronym, a_name)).cast("int")


# Plain functions behind the UDFs.


def jaro_winkler(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, mine = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                mine.append(c)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [c for c, u in zip(b, used, strict=True) if u]
    swapped = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest, with a's positions as the bits of integers."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    rows, every = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        met = rows & where.get(c, 0)
        rows = (rows + met | rows - met) & every
    return len(a) - rows.bit_count()


def fuzz_ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths."""
    return 2 * common_subsequence(a, b) / (len(a) + len(b)) if a and b else 0.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text to a window of the longer, cut windows at the ends included; with equal lengths, either way round."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    ways = [(a, b), (b, a)] if len(a) == len(b) else [(a, b) if len(a) < len(b) else (b, a)]
    return max(fuzz_ratio(s, long[max(0, at) : at + len(s)]) for s, long in ways for at in range(1 - len(s), len(long)))


def token_sort_ratio(a: str, b: str) -> float:
    return fuzz_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 1.0
    join = lambda s, t: f"{s} {t}".strip()
    best = fuzz_ratio(join(both, left), join(both, right))
    return max(best, fuzz_ratio(both, join(both, left)), fuzz_ratio(both, join(both, right))) if both else best


# The same for many pairs at once.


def common_subsequences(a: list[str], b: list[str]) -> np.ndarray:
    """common_subsequence() of each pair: a's positions as the bits of 64-bit words, one step for the i-th characters of all of b."""
    if len(a) == 0:
        return np.zeros(0, dtype="int64")
    (left, at), (right, of) = (np.unique(np.array(x, dtype=str), return_inverse=True) for x in (a, b))
    chars = lambda x: x.view(np.uint32).reshape(len(x), -1)  # padded with 0
    left, right = chars(left), chars(right)
    known = np.unique(np.append(left, 0))
    words = -(-left.shape[1] // 64)
    if len(a) > 1 and len(left) * len(known) * words > 1 << 21:
        half = len(a) // 2
        return np.concatenate([common_subsequences(a[:half], b[:half]), common_subsequences(a[half:], b[half:])])
    where = np.zeros((words, len(left), len(known)), dtype=np.uint64)
    for i, c in enumerate(np.searchsorted(known, left).T):
        where[i // 64, np.arange(len(left)), c] |= np.uint64(1 << i % 64)
    where[:, :, 0] = 0
    where = where.reshape(words, -1)
    place = np.minimum(np.searchsorted(known, right), len(known) - 1)
    place[known[place] != right] = 0
    rows, base = [np.full(len(a), 2**64 - 1, dtype=np.uint64) for _ in range(words)], at * len(known)
    for c in place.T:
        index, carry = base + c[of], None
        for w in range(words):
            met = where[w][index] & rows[w]
            total = rows[w] + met
            over = total < met
            if carry is not None:
                total += carry
                over |= total < carry
            rows[w] = total | (rows[w] & ~met)
            carry = over.astype(np.uint64)
    return sum(64 - np.bitwise_count(r).astype("int64") for r in rows)


def fuzzy_ratios(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """fuzz_ratio, token_set_ratio and token_sort_ratio of each pair."""
    def ratio(x, y):
        n = np.array([len(s) + len(t) if s and t else 0 for s, t in zip(x, y, strict=True)], dtype="int64")
        return np.where(n == 0, 0.0, 2 * common_subsequences(x, y) / np.maximum(n, 1))

    split = {s: s.split() for s in {*a, *b}}
    ordered, sets = {s: " ".join(sorted(t)) for s, t in split.items()}, {s: (sorted(set(t)), set(t)) for s, t in split.items()}
    left, right, n = [], [], []
    for s, t in zip(a, b, strict=True):
        (xs, x), (ys, y) = sets[s], sets[t]
        left.append(" ".join([w for w in xs if w not in y]))
        right.append(" ".join([w for w in ys if w not in x]))
        n.append((len(" ".join([w for w in xs if w in y])), bool(x and y)))
    both, some = np.array([x for x, _ in n], dtype="int64"), np.array([x for _, x in n], dtype=bool)
    p, q = (np.array([*map(len, x)], dtype="int64") for x in (left, right))
    start = np.where(both > 0, both + 1, 0)  # what is common comes first, so it is part of a longest subsequence
    best = 2 * (start + common_subsequences(left, right)) / np.maximum(2 * start + p + q, 1)
    best = np.where(both > 0, np.maximum(best, 2 * both / (2 * both + 1 + np.minimum(p, q))), best)
    best = np.where((both > 0) & ((p == 0) | (q == 0)), 1.0, best)
    return ratio(a, b), np.where(some, best, 0.0), ratio([ordered[s] for s in a], [ordered[s] for s in b])


@F.pandas_udf(StructType([StructField(c, DoubleType()) for c in ("ratio", "token_set", "token_sort")]))
def fuzzy(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """indel, token_set and token_sort in one call: for many pairs of few texts. The texts that differ least go into a."""
    return pd.DataFrame(dict(zip(("ratio", "token_set", "token_sort"), fuzzy_ratios(a.fillna("").tolist(), b.fillna("").tolist()), strict=True)))


def _udf(f):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict = {}
        out = []
        for pair in zip(a, b, strict=True):
            if pair not in known:
                known[pair] = f(pair[0] or "", pair[1] or "")
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return run


jaro = _udf(jaro_winkler)
indel = _udf(fuzz_ratio)
partial = _udf(partial_ratio)
token_sort = _udf(token_sort_ratio)
token_set = _udf(token_set_ratio)
