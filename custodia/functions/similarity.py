"""String similarity as Arrow UDFs: Spark has no built-in for these three measures.

They are only called on pairs that survived the native filters of
``operators.matching``.
"""

from __future__ import annotations

import sys
from difflib import SequenceMatcher

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship these functions inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The usual Jaro-Winkler constants and the blend of the two signals.
PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7
JARO_WINKLER_SHARE = 0.55
RATIO_SHARE = 0.45


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word of state per 64 characters."""
    seen: dict[str, int] = {}
    for i, ch in enumerate(a):
        seen[ch] = seen.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        hit = open_bits & seen.get(ch, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


def indel_ratio_of(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 2.0 * common_subsequence(a, b) / total if total else 1.0


def jaro_winkler_of(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    from_a = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                from_a.append(ch)
                break
    m = len(from_a)
    if not m:
        return 0.0
    from_b = [ch for j, ch in enumerate(b) if taken[j]]
    swaps = sum(x != y for x, y in zip(from_a, from_b)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3.0
    if jaro <= BOOST_ABOVE:
        return jaro
    shared = 0
    for x, y in zip(a[:PREFIX_LENGTH], b[:PREFIX_LENGTH]):
        if x != y:
            break
        shared += 1
    return jaro + PREFIX_WEIGHT * shared * (1.0 - jaro)


def matching_blocks_of(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def blended_of(a: str, b: str) -> float:
    score = JARO_WINKLER_SHARE * jaro_winkler_of(a, b) + RATIO_SHARE * indel_ratio_of(a, b)
    return max(0.0, min(1.0, score))


def _scored(fn, left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([fn(a, b) for a, b in zip(left, right)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def indel_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    return _scored(indel_ratio_of, left, right)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return _scored(jaro_winkler_of, left, right)


@F.pandas_udf(T.DoubleType())
def matching_blocks_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    return _scored(matching_blocks_of, left, right)


def name_signals(left: Column | str, right: Column | str) -> Column:
    """Struct of lev_ratio, jaro_winkler and their blend ``score``: both are computed once a pair, and the plan does not repeat the call."""
    return _signals(left, right)


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("lev_ratio", "jaro_winkler", "score")]))
def _signals(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    ratio, winkler = _scored(indel_ratio_of, left, right), _scored(jaro_winkler_of, left, right)
    score = (JARO_WINKLER_SHARE * winkler + RATIO_SHARE * ratio).clip(0.0, 1.0)
    return pd.DataFrame({"lev_ratio": ratio, "jaro_winkler": winkler, "score": score})


_signals = _signals.asNondeterministic()


@F.pandas_udf(T.DoubleType())
def blended_confidence(left: pd.Series, right: pd.Series) -> pd.Series:
    return _scored(blended_of, left, right)
