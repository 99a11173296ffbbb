"""Text cleaning and key normalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the key every missing code is conformed to.
MISSING_KEY = " "

# Spellings of a missing cell left behind by spreadsheet exports.
NULL_TOKENS = ("nan", "NaT")


def norm_key(c: Column) -> Column:
    """Upper-case, space-trimmed join key; NULL becomes ``MISSING_KEY``.

    A cell holding only spaces trims to the empty string, not to ``MISSING_KEY``;
    only ``blank_to_null`` on load turns such cells into missing keys. Folding comes last, so
    that the planner merges it with the folding of a join key.
    """
    return F.upper(trimmed_key(c))


def trimmed_key(c: Column) -> Column:
    """The same key in the letters it is written in."""
    return F.coalesce(F.trim(c), F.lit(MISSING_KEY))


def norm_text(c: Column, default: str = MISSING_KEY) -> Column:
    """Space-trimmed attribute with a default for NULL."""
    return F.coalesce(F.trim(c), F.lit(default))


def default_text(c: Column, default: str = MISSING_KEY) -> Column:
    """Attribute kept as it is, with a default for NULL."""
    return F.coalesce(c, F.lit(default))


def blank_to_null(c: Column) -> Column:
    """NULL for cells that are empty or hold only white space, the non-breaking kinds included."""
    return F.when(c.rlike(r"(?U)^\s*$"), F.lit(None)).otherwise(c)


def null_tokens(c: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """NULL for cells spelling a missing value."""
    return F.when(c.isin(*tokens), F.lit(None)).otherwise(c)


def clean_text(c: Column) -> Column:
    return null_tokens(blank_to_null(c))


def unit_label(unit_1: Column, unit_2_id: Column, unit_2: Column, plain_ids: Iterable[int] = (0,)) -> Column:
    """``unit_1-unit_2``, or ``unit_1`` alone where the second unit is absent.

    ``concat`` keeps NULL names NULL; a NULL id falls through to ``unit_1``.
    """
    return F.when(~unit_2_id.isin(*plain_ids), F.concat(unit_1, F.lit("-"), unit_2)).otherwise(unit_1)
