"""String helpers as column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_model_name(c) -> Column:
    """lower-case; space and '/' -> '_'; parentheses removed."""
    x = F.lower(F.col(c) if isinstance(c, str) else c)
    x = F.translate(x, " /", "__")
    return F.translate(x, "()", "")


def parse_horizons(c) -> Column:
    """'1, 24,,48' -> array<int>(1, 24, 48); blank items ignored."""
    parts = F.transform(F.split(F.col(c) if isinstance(c, str) else c, ","), lambda s: F.trim(s))
    return F.transform(F.filter(parts, lambda s: s != F.lit("")), lambda s: s.cast("int"))
