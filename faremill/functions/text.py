"""Text normalisation as the warehouse dialect defines it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters of the Unicode White_Space property, all removed by the dialect's
# TRIM (Spark's own trim removes spaces only).
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The characters at which the dialect's INITCAP starts a new word.
WORD_BREAKS = r"""\s\[\](){}/|<>!?@"^#$&~_,.:;*%+\-\\"""


def trim(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def lower_trim(col: Column) -> Column:
    return F.lower(trim(col))


def upper_trim(col: Column) -> Column:
    return F.upper(trim(col))


def title_case(col: Column) -> Column:
    """Upper-case the first letter of each word and lower-case the rest."""
    runs = F.regexp_extract_all(
        F.lower(col), F.lit(f"([{WORD_BREAKS}]+|[^{WORD_BREAKS}]+)"), F.lit(1)
    )
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), r.substr(F.lit(2), F.length(r)))),
        "",
    )
