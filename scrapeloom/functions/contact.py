"""Standardising expressions for category, phone, e-mail and web site."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column, is_null_like, strip, tidy

# Accepted spellings and their label. Look-up is case-sensitive.
CATEGORY_LABELS = {
    "legal": "Legal",
    "LEGAL": "Legal",
    "Lgl": "Legal",
    "Legal": "Legal",
    "ERP": "ERP",
    "HR": "HR",
    "Medical": "Medical",
    "MSP Platform": "MSP Platform",
    "LMS": "LMS",
}
UNKNOWN_CATEGORY = "Unknown"

# Phone extension marks, cut off together with all that follows.
EXTENSION = r"(?i)\s*(ext\.?|x\b|#)\s*\d+"
LONG_EXTENSION = r"(?i)\s*(ext(ension)?[.:]?|x|#)\s*\d+"


def canonical_labels(labels: Mapping[str, str] = CATEGORY_LABELS) -> list[str]:
    return sorted(set(labels.values()))


def _text(value: Column | str, tidied: bool) -> Column:
    return as_column(value) if tidied else tidy(value)


def clean_category(
    value: Column | str, labels: Mapping[str, str] = CATEGORY_LABELS, tidied: bool = False
) -> Column:
    """Canonical label; ``Unknown`` for other texts, NULL for null-like ones.

    Here and below, ``tidied`` says that the value is already trimmed and
    null-normalised, which saves doing it again.
    """
    c = _text(value, tidied)
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.when(c.isNotNull(), F.coalesce(F.try_element_at(lookup, c), F.lit(UNKNOWN_CATEGORY)))


def phone_digits(value: Column | str, extended_extensions: bool = False) -> Column:
    """All digits of a phone text, without its extension."""
    mark = LONG_EXTENSION if extended_extensions else EXTENSION
    number = F.split(strip(value), mark, 2).getItem(0)
    return F.regexp_replace(number, "[^0-9]", "")


def clean_phone(value: Column | str, extended_extensions: bool = False) -> Column:
    """Ten-digit phone, NULL if the text does not lead to ten digits.

    An eleven-digit number loses a leading 1; a leading 0 always goes, so that
    ten digits from 0 on are too few.
    """
    digits = phone_digits(value, extended_extensions)
    national = "^(?:[01](?=[0-9]{10}$)|(?=[1-9]))([0-9]{10})$"
    return F.nullif(F.regexp_extract(digits, national, 1), F.lit(""))


def clean_email(value: Column | str, tidied: bool = False) -> Column:
    """Lower-cased e-mail; a malformed one is kept, see :func:`email_flag`."""
    return F.lower(_text(value, tidied))


def clean_website(value: Column | str, tidied: bool = False) -> Column:
    return F.lower(_text(value, tidied))


def phone_flag(value: Column | str, cleaned: Column | str, tidied: bool = False) -> Column:
    """``null``, ``ok`` or ``invalid`` for a phone text and its cleaned form."""
    return _flag(value, as_column(cleaned).isNotNull(), tidied)


def email_flag(value: Column | str, tidied: bool = False) -> Column:
    c = as_column(value)
    return _flag(c, c.contains("@") & c.contains("."), tidied)


def _flag(value: Column | str, good: Column, tidied: bool) -> Column:
    c = as_column(value)
    missing = c.isNull() if tidied else is_null_like(c)
    return F.when(missing, "null").when(good, "ok").otherwise("invalid")


def site_key(website: Column | str) -> Column:
    """Site text without scheme and ``www.``; path and port stay (site report)."""
    bare = F.regexp_replace(F.lower(as_column(website)), "^https?://", "")
    return F.regexp_replace(bare, r"^www\.", "")


def site_host(website: Column | str) -> Column:
    """Host name used for matching: no scheme, ``www.``, path or port."""
    bare = site_key(strip(website))
    host = F.split_part(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit(":"), F.lit(1))
    return F.nullif(host, F.lit(""))
