"""Text normalisation, tokens, n-grams and report fragments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postgauge.config import TEXT, TITLE, FeatureSpec

# What counts as a URL, a control character, white space and a word.
URL_PATTERN = r"(?U)https?://[^\s\x{1c}-\x{1f}]+|www\.[^\s\x{1c}-\x{1f}]+"
CONTROL_PATTERN = r"[\x{00}-\x{1f}\x{7f}-\x{9f}]"
SPACE_PATTERN = r"(?U)[\s\x{1c}-\x{1f}]+"
EDGE_SPACE_PATTERN = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
URL_TOKEN = " url_token "


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.regexp_replace(text, EDGE_SPACE_PATTERN, "")


def join_title_text(title: Column | str = TITLE, text: Column | str = TEXT) -> Column:
    """Title, a newline and the body; missing parts count as empty."""
    return F.concat_ws(
        "\n", *(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (title, text))
    )


def normalize_text(text: Column) -> Column:
    """Lower case, URLs to one token, control characters and runs of space to one space."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    linked = F.regexp_replace(lowered, URL_PATTERN, URL_TOKEN)
    printable = F.regexp_replace(linked, CONTROL_PATTERN, " ")
    return F.trim(F.regexp_replace(printable, SPACE_PATTERN, " "))


def normalized_post(title: Column | str = TITLE, text: Column | str = TEXT) -> Column:
    """The model input of one post."""
    return normalize_text(join_title_text(title, text))


def truncate(text: Column, limit: int) -> Column:
    return F.substring(text, 1, limit)


def fragment(text: Column, limit: int = 320) -> Column:
    """One-line excerpt of at most ``limit`` characters."""
    line = strip(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_PATTERN, " "))
    cut = F.rtrim(F.substring(line, 1, limit - 3))
    return F.when(F.length(line) <= limit, line).otherwise(F.concat(cut, F.lit("...")))


def words(text: Column) -> Column:
    """Word tokens: runs of at least two letters, digits or underscores."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def _once(value: Column, use) -> Column:
    """``use(value)`` for an array result, with ``value`` computed once per row.

    A column repeated inside a lambda is evaluated again for every element;
    a lambda variable is not.
    """
    return F.flatten(F.transform(F.array(value), use))


def word_ngrams(tokens: Column, min_n: int, max_n: int) -> Column:
    """All runs of ``min_n`` to ``max_n`` neighbouring tokens, joined by a space."""
    if max_n == 1:
        return tokens

    def runs(bound: Column, n: int) -> Column:
        if n == 1:
            return bound
        starts = F.sequence(F.lit(1), F.size(bound) - (n - 1))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(bound, i, n), " "))
        return F.when(F.size(bound) >= n, joined).otherwise(F.array().cast("array<string>"))

    return _once(tokens, lambda t: F.concat(*(runs(t, n) for n in range(min_n, max_n + 1))))


def char_ngrams(padded: Column, min_n: int, max_n: int) -> Column:
    """Character runs that stay inside one padded word.

    Works on one padded word or on a whole padded text: only the outer characters of a
    run may be spaces. The look-ahead finds overlapping runs; a run never starts in the
    middle of a surrogate pair.
    """
    first = r"[^\x{dc00}-\x{dfff}]"
    found = (
        F.regexp_extract_all(padded, F.lit(rf"(?s)(?=({first}[^ ]{{{n - 2}}}.))"), F.lit(1))
        for n in range(min_n, max_n + 1)
    )
    return F.concat(*found)


def terms(text: Column, spec: FeatureSpec) -> Column:
    """Every term occurrence of a normalised text, as an array."""
    if spec.analyzer == "word":
        return word_ngrams(words(text), spec.min_n, spec.max_n)
    return char_ngrams(F.concat(F.lit(" "), text, F.lit(" ")), spec.min_n, spec.max_n)


def distinct_terms(text: Column, spec: FeatureSpec) -> Column:
    """The terms of a text without repetition, found inside the row."""
    return F.array_distinct(terms(text, spec))
