from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def only_digits(c) -> Column:
    """Keep ASCII digits only; null, or nothing left, gives null (document numbers)."""
    return F.nullif(F.regexp_replace(_col(c).cast("string"), r"[^0-9]", ""), F.lit(""))


def person_type(doc) -> Column:
    """'PJ' for documents longer than 11 digits (company), else 'PF' (person)."""
    return F.when(F.length(_col(doc)) > 11, F.lit("PJ")).otherwise(F.lit("PF"))
