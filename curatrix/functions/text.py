"""Column functions on text with Python's notion of whitespace and letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode whitespace plus the zero-width characters, as a Java character class body.
SPACE = r"\s ​‌‍⁠﻿"


def py_strip(c: Column) -> Column:
    """Strips all Unicode whitespace at both ends; null stays null."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def squeeze(c: Column) -> Column:
    """Runs of whitespace and zero-width characters become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"(?U)[{SPACE}]+", " "))


def is_blank(c: Column) -> Column:
    """True for null and for texts without a visible character."""
    return F.coalesce(~c.rlike(rf"(?U)[^{SPACE}]"), F.lit(True))


def truthy(c: Column) -> Column:
    """Not null and not the empty string."""
    return F.coalesce(F.length(c) > 0, F.lit(False))
