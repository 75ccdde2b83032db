"""Text expressions shared by all stages. All run JVM-side."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in the source data.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts that mean "no value" after trimming and lower-casing.
NULL_TOKENS = ("nan", "none", "null", "n/a", "na", "nil", "", "-")

# Cell texts that a CSV reader already takes as missing (exact match).
CSV_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# City texts that stand for "unknown" (case-sensitive).
CITY_PLACEHOLDERS = ("-", "NaN", "none", "null", "n/a", "")


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove leading and trailing white space of any script."""
    return F.btrim(as_column(value), F.lit(WHITESPACE))


def is_null_like(value: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """True for NULL and for texts such as ``" NaN "`` or ``"-"``."""
    c = as_column(value)
    return c.isNull() | F.lower(strip(c)).isin(*tokens)


def is_blank(value: Column | str) -> Column:
    """True for NULL and for texts made of blanks only."""
    c = as_column(value)
    return c.isNull() | (F.trim(c) == "")


def null_csv_na(value: Column | str, tokens: Iterable[str] = CSV_NA_TOKENS) -> Column:
    """NULL where the cell holds one of the reader's missing-value texts."""
    c = as_column(value)
    return F.when(~c.isin(*tokens), c)


def tidy(value: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Trimmed text, NULL where the text is null-like.

    Only texts short enough to be a token are lower-cased and looked up.
    """
    tokens = list(tokens)
    trimmed = strip(value)
    longest = max(map(len, tokens))
    return F.when(F.length(trimmed) > longest, trimmed).when(
        ~F.lower(trimmed).isin(*tokens), trimmed
    )


def normalise_name(value: Column | str) -> Column:
    """Company name reduced to lower-case words; NULL becomes the empty text."""
    other = WHITESPACE.replace(" ", "")
    words = F.trim(F.translate(F.lower(as_column(value)), other, " " * len(other)))
    letters = F.regexp_replace(words, r"[^\p{L}\p{N}_ ]+", "")
    return F.coalesce(F.regexp_replace(letters, "  +", " "), F.lit(""))


def known_city(value: Column | str) -> Column:
    """City, NULL where it is a placeholder."""
    c = as_column(value)
    return F.when(F.trim(c).isin(*CITY_PLACEHOLDERS), None).otherwise(c)


def joined_labels(value: Column | str) -> Column:
    """Aggregate: sorted distinct labels joined with ``|``. For label sets of
    bounded size only, as one group keeps its whole set."""
    return F.array_join(F.array_sort(F.collect_set(as_column(value))), "|")


def quoted(names: Iterable[str]) -> list[str]:
    """Column names to select by, also those that hold a dot or a back-quote."""
    return ["`" + name.replace("`", "``") + "`" for name in names]
