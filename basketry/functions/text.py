"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python counts as white space; Spark's plain trim removes blanks only.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def quoted(name: str) -> Column:
    """A column by its exact name, whatever stands in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(col: Column) -> Column:
    """Without white space at the ends. Blanks go first: trimming them is fast, trimming a set of characters is slow for
    each character it takes off."""
    return F.btrim(F.trim(col), F.lit(WHITESPACE))


def strip_lower(col: Column) -> Column:
    return F.lower(strip(col))


def lookup(col: Column, pairs: dict[str, str]) -> Column:
    """Replace the values listed in ``pairs``; all others, and nulls, pass through."""
    entries = [F.lit(part) for pair in pairs.items() for part in pair]
    return F.coalesce(F.create_map(*entries)[col], col)


def missing_as_null(col: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(~col.isin(*tokens), col)


def shorten(col: Column, limit: int = 50) -> Column:
    return F.when(F.length(col) > limit, F.concat(F.left(col, F.lit(limit)), F.lit("…"))).otherwise(col)


def euros(col: Column) -> Column:
    return F.concat(F.lit("€"), F.format_number(col, 0))


def thousands(col: Column) -> Column:
    return F.format_number(col, 0)


def percent(col: Column) -> Column:
    return F.concat(F.format_number(col, 1), F.lit("%"))


def times(col: Column) -> Column:
    return F.concat(F.format_number(col, 1), F.lit("×"))
