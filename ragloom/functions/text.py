"""Text and number expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword / statement token used by the lexical metrics and the derived
# fixtures: a run of six or more letters of any script.
KEYWORD_PATTERN = r"\p{L}{6,}"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value, body) -> Column:
    """``body`` of a value that is computed once for the row, however often
    (or inside whatever lambda) the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def tokens(text, pattern: str = KEYWORD_PATTERN) -> Column:
    """All matches of ``pattern`` in ``text`` (duplicates and order kept)."""
    return F.regexp_extract_all(_c(text), F.lit(pattern), F.lit(0))


def word_runs(text, min_len: int = 6) -> Column:
    """Maximal runs of letters at least ``min_len`` long, in
    order: exactly the matches of ``\\p{L}{min_len,}``, found by one linear
    split on the non-letters instead of a regex search that restarts inside
    every shorter word."""
    return F.filter(F.split(_c(text), r"\P{L}+"), lambda t: F.length(t) >= min_len)


def lower_tokens(text, pattern: str = KEYWORD_PATTERN) -> Column:
    """Tokens of the lower-cased text."""
    low = F.lower(_c(text))
    if pattern == KEYWORD_PATTERN:
        return word_runs(low, 6)
    return tokens(low, pattern)


def keyword_recall(keywords, haystack, empty_is_zero: bool = False) -> Column:
    """Share of ``keywords`` (lower-cased) that occur as substrings of the
    already lower-cased ``haystack``.  Duplicated keywords count twice; a
    keyword may match across a seam; an empty keyword matches.

    ``empty_is_zero`` gives 0.0 for an empty keyword list (generation rule);
    otherwise the result is null for an empty list (the retrieval rule
    skips such cases before scoring).
    """
    kw = _c(keywords)
    hay = _c(haystack)
    found = F.size(F.filter(kw, lambda k: F.contains(hay, F.lower(k))))
    share = F.try_divide(found.cast("double"), F.size(kw).cast("double"))
    if empty_is_zero:
        return F.when(F.size(kw) == 0, F.lit(0.0)).otherwise(share)
    return share


def basename_or_unknown(path) -> Column:
    """File name of a path; null or empty gives ``unknown``."""
    last = F.element_at(F.split(_c(path), "/"), -1)
    return F.coalesce(F.nullif(last, F.lit("")), F.lit("unknown"))


def preview(text, n: int = 200) -> Column:
    """First ``n`` characters followed by an ellipsis."""
    return F.concat(F.substring(_c(text), 1, n), F.lit("..."))


def round6(c) -> Column:
    """Six places after a 12-place pre-round (as :func:`bround_stable`), so
    that the last-bit noise of a parallel sum -- whose order depends on the
    partitioning -- cannot move a value across a half-way point."""
    return F.round(F.round(_c(c), 12), 6)


def bround_stable(c, scale: int = 4) -> Column:
    """Half-to-even rounding after a 12-place pre-round, so that the last-bit
    noise of a parallel sum cannot flip a half-way case."""
    return F.bround(F.round(_c(c), 12), scale)
