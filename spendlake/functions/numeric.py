from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_num(c, default: float = 0.0) -> Column:
    """Tolerant numeric parse: junk, null and the text 'NaN' all give ``default``."""
    v = _col(c).cast("string").try_cast("double")
    return F.coalesce(F.nanvl(v, F.lit(default)), F.lit(default))


def parse_bool(c) -> Column:
    """Proper boolean cast (the text 'false' is False); absent or junk gives False."""
    return F.coalesce(_col(c).cast("string").try_cast("boolean"), F.lit(False))


def to_money(c) -> Column:
    """Money as decimal(18,2); cast before summing so sums are exact."""
    return _col(c).cast(MONEY)
