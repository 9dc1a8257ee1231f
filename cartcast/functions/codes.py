"""Value recoding Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Contest product category -> dense code.
CATEGORY_CODES = {101: 0, 1: 1, 83: 2, 71: 3, 30: 4, 46: 5}
# Comment score level -> points.
LEVEL_POINTS = {1: 3, 2: 1, 3: -4}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode(c, mapping: Mapping, strict: bool = False) -> Column:
    """Map values through ``mapping``; unknown → null, or an error if strict."""
    c = _col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if strict:
        return expr.otherwise(F.raise_error(F.concat(F.lit("unknown code: "), c.cast("string"))))
    return expr


def score_of_level(c, strict: bool = False) -> Column:
    return recode(c, LEVEL_POINTS, strict)


def clamp_min(c, low=0) -> Column:
    """Clamp values below ``low`` up to it (F8)."""
    return F.greatest(_col(c), F.lit(low))


def clip_unit(c) -> Column:
    """Clip into [0, 1]."""
    return F.least(F.greatest(_col(c), F.lit(0.0)), F.lit(1.0))
