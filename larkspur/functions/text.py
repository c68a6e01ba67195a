"""Text expressions. Everything here is a native Spark expression, no UDFs."""

from __future__ import annotations

from collections.abc import Iterable
from string import ascii_letters, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python strips from both ends of a text.
STRIP_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# What cleaning removes (a literal plus sign is kept) and what separates tokens.
# What is kept is listed one by one, so Java's matcher looks a character up in a single table;
# with ranges and \s it asks one after another and takes about nine times as long.
NOT_KEPT_WHEN_CLEANING = rf"[^{ascii_letters}{digits} \t\n\x0b\f\r+]"
TOKEN_SEPARATOR = r"\W+"


def pluralise(word: Column) -> Column:
    """Append an ``s``; no grammar rules."""
    return F.concat(word, F.lit("s"))


def clean_text(text: Column) -> Column:
    """Strip, lower-case, then drop all but ASCII letters, digits, blanks and ``+``.

    Stripping comes first, so a blank that only becomes the edge once punctuation is
    gone stays. An explicit strip set is used because ``trim`` removes U+0020 only.
    """
    stripped = F.btrim(text, F.lit(STRIP_CHARACTERS))
    return F.regexp_replace(F.lower(stripped), NOT_KEPT_WHEN_CLEANING, "")


def split_on_blank(text: Column) -> Column:
    """Split on every single blank; empty pieces are kept."""
    return F.split(text, " ")


def remove_quotes(text: Column) -> Column:
    return F.translate(text, '"', "")


def tokens(text: Column) -> Column:
    """Lower-case word tokens, duplicates and underscores kept, empties dropped."""
    return F.filter(F.split(F.lower(text), TOKEN_SEPARATOR), lambda t: t != "")


def tokens_without(text: Column, stopwords: Iterable[str] = ()) -> Column:
    """:func:`tokens` minus a list of stopwords, keeping duplicates.

    For a word list too long for a literal set, explode the tokens and use
    :func:`larkspur.operators.counting.exclude_words`.
    """
    words = sorted(set(stopwords))
    if not words:
        return tokens(text)
    return F.filter(F.split(F.lower(text), TOKEN_SEPARATOR),
                    lambda t: (t != "") & ~t.isin(words))


def numbered_line(index: Column, line: Column) -> Column:
    """``index: line``"""
    return F.concat_ws(": ", index.cast("string"), line)


def float_text(number: Column) -> Column:
    """A number as text with twelve significant digits and at least one decimal.

    Meant for magnitudes from 0.1 up to 10 million, where Spark prints plain decimals.
    """
    value = number.cast("double")
    text = F.when(F.abs(value) < 1, F.round(value, 12))
    for whole_digits in range(1, 8):
        text = text.when(F.abs(value) < 10 ** whole_digits,
                         F.round(value, 12 - whole_digits))
    return text.otherwise(value).cast("string")


def text_sort_key(key: Column, value: Column, is_float: bool = False) -> Column:
    """``key value`` as one text, the key in its printed form."""
    printed = float_text(key) if is_float else key.cast("string")
    return F.concat_ws(" ", printed, value)


def sha1_of(value: Column) -> Column:
    """SHA-1 of the value's printed form."""
    return F.sha1(value.cast("string"))
