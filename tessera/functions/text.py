"""Text column functions: cleaning and tokenising with built-in regex and
array functions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation and stop words that cleaning removes, and the
# Keras default filter set.
PUNCTUATION = "!()-[]{};:'\"\\,<>./?@#$%^&*_~"
STOP_WORDS = ("the", "a", "and", "is", "be", "will")
KERAS_FILTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"

# What counts as an address and as a tag.
URL_PATTERN = r"https?://\S+|www\.\S+"
TAG_PATTERN = r"<.*?>"
# Words: runs of two or more Unicode letters, digits or underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_text(text, stop_words: list[str] = STOP_WORDS, punctuation: str = PUNCTUATION) -> Column:
    """Strip URLs, strip tags, delete punctuation, lower, drop stop words,
    squeeze blanks - in that order."""
    s = F.regexp_replace(_c(text), URL_PATTERN, "")
    s = F.regexp_replace(s, TAG_PATTERN, "")
    s = F.translate(s, punctuation, "")
    s = F.lower(s)
    toks = F.split(F.trim(s), r"\s+")
    if stop_words:
        stops = F.array(*[F.lit(w) for w in stop_words])
        toks = F.filter(toks, lambda t: ~F.array_contains(stops, t))
    toks = F.filter(toks, lambda t: t != "")
    return F.array_join(toks, " ")


def keras_tokens(text, filters: str = KERAS_FILTERS) -> Column:
    """X2 (sequence style): lower, replace filter characters by blanks, split."""
    s = F.lower(_c(text))
    # translate maps each filter character to a blank
    s = F.translate(s, filters, " " * len(filters))
    return F.filter(F.split(s, " "), lambda t: t != "")


def count_tokens(text, lowercase: bool = True) -> Column:
    """X2 (count style): words of two or more word characters."""
    s = F.lower(_c(text)) if lowercase else _c(text)
    return F.regexp_extract_all(s, F.lit(WORD_PATTERN), 0)
