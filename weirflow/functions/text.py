"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.functions.fixed import DATE_FORMATS, NULL_MARKERS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_marker(c, markers: Sequence[str] = tuple(NULL_MARKERS), trimmed: bool = False) -> Column:
    """NULL for texts that mean "missing", otherwise the text as it is."""
    c = _col(c)
    return F.when(~F.lower(c if trimmed else F.trim(c)).isin(*markers), c)


def category(c) -> Column:
    """Upper case with spaces and dashes as underscores."""
    return F.translate(F.upper(F.trim(_col(c))), " -", "__")


def identifier(c) -> Column:
    """Letters, digits and dashes only."""
    return F.regexp_replace(_col(c), "[^A-Za-z0-9-]", "")


def number(c) -> Column:
    """Number from text; thousands separators allowed, anything unreadable is NULL."""
    return F.replace(_col(c), F.lit(","), F.lit("")).try_cast("double")


def parse_date(c, formats: Sequence[tuple[str, str]] = tuple(DATE_FORMATS)) -> Column:
    """First format that reads the text; NULL if none does. Month names in any case.

    The shape test in front of each parse matters: a failed parse throws inside the JVM, which costs
    far more than a match.
    """
    text = _col(c)
    parts = F.split(text, "-")
    month_case = F.concat_ws(
        "-", F.get(parts, F.lit(0)), F.initcap(F.get(parts, F.lit(1))), F.get(parts, F.lit(2))
    )
    return F.coalesce(*[
        F.when(text.rlike(shape), F.try_to_date(month_case if "MMM" in f else text, f)) for f, shape in formats
    ])


def normalized(c) -> Column:
    """Lower case without punctuation; letters of every script are kept."""
    return F.regexp_replace(F.lower(_col(c)), r"(?U)[^\w\s]", "")


def words(c) -> Column:
    """Tokens between runs of whitespace, without empty ones."""
    return F.filter(F.split(_col(c), r"(?U)\s+"), lambda w: w != "")


def masked(c, visible_from: int = 5, mark: str = "*") -> Column:
    """Hide the first characters; shorter texts are hidden whole."""
    c = _col(c)
    hidden = F.least(F.length(c), F.lit(visible_from))
    return F.concat(F.repeat(F.lit(mark), hidden), F.substring(c, visible_from + 1, 2_000_000_000))
