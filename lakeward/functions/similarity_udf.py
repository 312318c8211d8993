"""Jaro-Winkler similarity as an Arrow-batched pandas UDF (not among Spark's built-ins).

Only applied to the distinct candidate name pairs of a block, never to all pairs or to raw rows.
Prefix scale 0.1 over at most 4 leading characters, applied when the Jaro score exceeds 0.7;
an empty side scores 0.0.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def jaro(s: str, t: str) -> float:
    if not s or not t:
        return 0.0
    if s == t:
        return 1.0
    ls, lt = len(s), len(t)
    window = max(max(ls, lt) // 2 - 1, 0)
    s_hit, t_hit = [False] * ls, [False] * lt
    matches = 0
    for i, c in enumerate(s):
        for j in range(max(0, i - window), min(lt, i + window + 1)):
            if not t_hit[j] and t[j] == c:
                s_hit[i] = t_hit[j] = True
                matches += 1
                break
    if matches == 0:
        return 0.0
    k = half_transpositions = 0
    for i in range(ls):
        if s_hit[i]:
            while not t_hit[k]:
                k += 1
            if s[i] != t[k]:
                half_transpositions += 1
            k += 1
    tr = half_transpositions // 2
    return (matches / ls + matches / lt + (matches - tr) / matches) / 3.0


def jaro_winkler(s: str | None, t: str | None, prefix_scale: float = 0.1, boost_threshold: float = 0.7) -> float | None:
    if s is None or t is None:
        return None
    j = jaro(s, t)
    if j > boost_threshold:
        prefix = 0
        for a, b in zip(s[:4], t[:4]):
            if a != b:
                break
            prefix += 1
        j += prefix * prefix_scale * (1.0 - j)
    return j


def _jw_batch(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


_UDF = {}


def _jw_udf(a: Column, b: Column) -> Column:
    # built on first use on the driver (not at import, which also happens inside Python workers)
    if "jw" not in _UDF:
        _UDF["jw"] = pandas_udf(_jw_batch, "double")
    return _UDF["jw"](a, b)


def jaro_winkler_similarity(a: Column | str, b: Column | str) -> Column:
    """Jaro-Winkler similarity column, rounded to 4 places like the other scores."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.round(_jw_udf(a, b), 4)
