"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(text, F.lit(WHITESPACE))


def zero_fill(text: Column, width: int) -> Column:
    """Left-pad with zeros up to ``width``; longer text is kept whole."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def municipality_key(code: Column, width: int = 6) -> Column:
    """Join key of a municipality code: its first ``width`` digits, zero-filled."""
    return zero_fill(F.substring(code.cast("string"), 1, width), width)


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    ``initcap`` starts a word only after a blank and so leaves ``Centro-oeste``.
    """
    pieces = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(
        F.transform(
            pieces,
            lambda piece: F.concat(
                F.upper(F.substring(piece, 1, 1)), F.lower(F.substr(piece, F.lit(2)))
            ),
        ),
        "",
    )


def place_label(name: Column, uf: Column) -> Column:
    """``Campinas (SP)``."""
    return F.concat(name, F.lit(" ("), uf, F.lit(")"))
