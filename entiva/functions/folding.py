"""Accent folding as native column expressions.

The tables are generated once from ``unicodedata`` instead of being typed in, and are
applied with built-in functions so that no Python runs per row.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEPT = re.compile(r"[^A-Z0-9 ]")


@lru_cache(maxsize=1)
def folding_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Return (one-to-one, one-to-many) folds for BMP characters above ASCII.

    A character folds to what its NFKD form leaves in ``[A-Z0-9 ]``. Characters that leave
    nothing are not listed: the alphanumeric filter removes them later anyway.
    """
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        ascii_form = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        kept = _KEPT.sub("", ascii_form)
        if len(kept) == 1:
            single[char] = kept
        elif kept:
            several[char] = kept
    return single, several


def fold_compatibility(c: Column) -> Column:
    """Fold upper-cased text to ASCII the way NFKD does.

    Only rows that hold one of the (rare) one-to-many characters are taken apart; the table
    for them is one constant map, so the expression stays small enough to be compiled.
    """
    single, several = folding_tables()
    pairs = "|".join(f"{char}={kept}" for char, kept in several.items())
    table = F.str_to_map(F.lit(pairs), F.lit("[|]"), F.lit("="))
    folded = F.translate(c, "".join(single), "".join(single.values()))
    expanded = F.array_join(
        F.transform(
            F.split(folded, ""), lambda char: F.coalesce(F.try_element_at(table, char), char)
        ),
        "",
    )
    # Deleting the characters and comparing is several times faster than a regex class.
    has_several = F.translate(folded, "".join(several), "") != folded
    # Most names are plain ASCII, which has nothing to fold, and most others are once folded.
    return (
        F.when(_is_ascii(c), c)
        .when(_is_ascii(folded) | ~has_several, folded)
        .otherwise(expanded)
    )


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


# The accented capitals that the regex name rule folds, and their plain letters.
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUC"


def fold_listed(c: Column) -> Column:
    """Fold only the listed accented capitals; anything else is left as it is."""
    return F.translate(c, ACCENTED, PLAIN)
