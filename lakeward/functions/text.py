"""Text standardisation and name-similarity expressions (all built-in Catalyst expressions)."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..governance import AUTO_MERGE, CONFIDENCE_WEIGHTS, REJECT, STEWARD_REVIEW


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_text(col: Column | str) -> Column:
    """The ASCII words of the upper-cased text, joined by one blank; NULL stays NULL.

    A word is a run of ``A-Z`` and ``0-9``; everything else only separates words.
    """
    words = F.regexp_extract_all(F.upper(_c(col).cast("string")), F.lit("[A-Z0-9]+"), F.lit(0))
    return F.array_join(words, " ")


def upper_trim(col: Column | str) -> Column:
    """The lighter standardisation declared for the borough attribute: upper + trim only."""
    return F.upper(F.trim(_c(col).cast("string")))


def first_token(col: Column | str) -> Column:
    """What stands before the first blank (``''`` for an empty text, NULL for NULL)."""
    return F.substring_index(_c(col), " ", 1)


def similarity_of_distance(distance: Column, longest: Column) -> Column:
    """``1 - distance / longest`` to 4 places; two empty names (``longest`` 0) count as 0.0."""
    ratio = F.round(1 - distance / F.nullif(longest, F.lit(0)), 4)
    return F.when(longest.isNotNull(), F.when(longest > 0, ratio).otherwise(F.lit(0.0)))


def lev_similarity(a: Column | str, b: Column | str) -> Column:
    """Similarity of two names by edit distance.

    ``greatest`` skips NULLs, so one NULL side and one empty side also gives 0.0; otherwise a
    NULL side gives NULL.
    """
    a, b = _c(a), _c(b)
    return similarity_of_distance(F.levenshtein(a, b), F.greatest(F.length(a), F.length(b)))


def token_match(token_a: Column | str, token_b: Column | str) -> Column:
    """1.0 when both tokens are known and equal, else 0.0."""
    return F.coalesce((_c(token_a) == _c(token_b)).cast("double"), F.lit(0.0))


def match_confidence(*evidence: Column | str) -> Column:
    """Evidence (name similarity, token match) under the declared weights, to 4 places."""
    weighted = [_c(value) * F.lit(weight) for value, weight in zip(evidence, CONFIDENCE_WEIGHTS, strict=True)]
    return F.round(reduce(operator.add, weighted), 4)


def decision(confidence: Column | str, high: float, medium: float) -> Column:
    """The highest band whose floor the confidence reaches; below every floor (and NULL) REJECT."""
    out = F.lit(REJECT)
    for floor, label in sorted(((medium, STEWARD_REVIEW), (high, AUTO_MERGE)), key=lambda band: band[0]):
        out = F.when(_c(confidence) >= F.lit(float(floor)), F.lit(label)).otherwise(out)
    return out


def concat_key(block: Column | str, name: Column | str) -> Column:
    """Deterministic match key ``block::name``; ``concat_ws`` skips a NULL part."""
    return F.concat_ws("::", _c(block), _c(name))


def declared_key(borough: Column | str, zone: Column | str) -> Column:
    """Declared blocking expression ``UPPER(TRIM(b)) || '::' || UPPER(TRIM(z))`` (NULL if either is NULL)."""
    return F.concat(upper_trim(borough), F.lit("::"), upper_trim(zone))
