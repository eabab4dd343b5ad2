"""Join keys: names and tax ids brought to one spelling, as pure column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.functions.folding import fold_compatibility, fold_listed

# Legal suffixes cut from upper-cased names, in this order.
LEGAL_SUFFIXES = ("- PRUDENCIAL", "(CONGLOMERADO)", "S.A.", "LTDA", "S/A")

# Fixed value: the same idea as one regular expression (replaced by a space, any case).
LEGAL_SUFFIX_PATTERN = r"\(.*?\)| - PRUDENCIAL|\bS/?\.?A\.?\b|\bLTDA\b"

# Fixed value: the characters of a normalised name.
KEPT = string.ascii_uppercase + string.digits + " "


def _as_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _alphanumeric(c: Column) -> Column:
    # What is left without the kept characters is what to delete. A regex class took most of
    # the time of the trusted layer, names with nothing to delete included.
    others = F.translate(c, KEPT, "")
    cleaned = F.when(others == "", c).otherwise(
        F.call_function("translate", c, others, F.lit(""))
    )
    return F.trim(F.regexp_replace(cleaned, "  +", " "))


def normalize_name(c: Column) -> Column:
    """Literal-suffix rule: upper, cut suffixes anywhere, NFKD fold, keep ``[A-Z0-9 ]``.

    Null becomes ``""``; an empty name is "no key" everywhere else in this package.
    """
    value = F.upper(F.trim(_as_text(c)))
    for suffix in LEGAL_SUFFIXES:
        value = F.replace(value, F.lit(suffix), F.lit(""))
    return _alphanumeric(fold_compatibility(value))


def normalize_name_by_pattern(c: Column) -> Column:
    """Regex rule: suffixes become a space, only the common Latin accents are folded."""
    value = F.upper(F.trim(_as_text(c)))
    value = F.regexp_replace(value, "(?i)" + LEGAL_SUFFIX_PATTERN, " ")
    return _alphanumeric(fold_listed(value))


def normalize_id(c: Column) -> Column:
    """Digits only, without leading zeros; null, blank and ``0`` become ``""``."""
    return F.regexp_replace(F.regexp_replace(_as_text(c), "[^0-9]", ""), "^0+", "")


def key_present(c: Column) -> Column:
    """True when a key is neither null nor empty, never null itself (safe to negate)."""
    return c.isNotNull() & (c != "")


def only_keyed(df: DataFrame, key: str) -> DataFrame:
    """The rows that have the key. As a filter, a comparison with ``""`` is enough."""
    return df.filter(F.col(key) != "")
