"""String helpers: defaults, prefixes, previews, length estimates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.fixed_values import PREVIEW_CHARS

# Characters str.strip() removes.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    The optimizer inlines a projected column into a lambda, where it would be
    computed again per array element. Binding it as the single element of an
    array keeps it out of the inner loop.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(c: Column | str) -> Column:
    """Missing value -> ``""``, everything else as string."""
    return F.coalesce(as_column(c).cast("string"), F.lit(""))


def remove_prefix(c: Column | str, prefix: str) -> Column:
    """Drop ``prefix`` once, literally, when the value starts with it."""
    c = as_column(c)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 2**31 - 1)).otherwise(c)


def preview(c: Column | str, n: int = PREVIEW_CHARS) -> Column:
    """First ``n`` characters, for reports on rejected rows."""
    return F.substring(as_column(c), 1, n)


def strip(c: Column | str) -> Column:
    """Remove whitespace at both ends; the costly call runs only where needed."""
    c = as_column(c)
    marks = list(WHITESPACE)
    touched = F.substring(c, 1, 1).isin(marks) | F.substring(c, -1, 1).isin(marks)
    return F.when(touched, F.trim(c, F.lit(WHITESPACE))).otherwise(c)


def literal_pattern(s: str) -> str:
    """A regular expression that matches ``s`` literally."""
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in s)


def split_literal(c: Column | str, separator: str) -> Column:
    """All pieces between literal separators, trailing empty ones included."""
    return F.split(as_column(c), literal_pattern(separator), -1)


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words (0 for an empty or missing text)."""
    c = F.coalesce(as_column(c), F.lit(""))
    return F.regexp_count(c, F.lit("\\S+")).cast("bigint")


def quarter_chars(c: Column | str) -> Column:
    """One token per four characters, rounded up."""
    return F.ceil(F.length(F.coalesce(as_column(c), F.lit(""))) / F.lit(4)).cast("bigint")


# Length estimates stand in for a tokenizer; both are rough on purpose.
LENGTH_ESTIMATES: dict[str, Callable[[Column | str], Column]] = {
    "words": word_count,
    "chars4": quarter_chars,
}


def estimate_length(c: Column | str, est: str | Callable[[Column], Column] = "words") -> Column:
    """Length of a text by a named estimate or by the caller's own expression."""
    return (LENGTH_ESTIMATES[est] if isinstance(est, str) else est)(as_column(c))


def first_words(c: Column | str, n: int) -> Column:
    """The text up to the end of its ``n``-th word, inner whitespace untouched.

    The split is bounded, so the tail of a long text stays one piece.
    """
    pieces = F.split(as_column(c), "(?<=\\S)(?=\\s)", n + 1)
    return F.array_join(F.slice(pieces, 1, n), "")
