from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portuguese day names (Monday first) and month names (January first),
# as the reference's calendar dimension labels them.
DAY_NAMES_PT = ["segunda", "terça", "quarta", "quinta", "sexta", "sábado", "domingo"]
MONTH_NAMES_PT = [
    "janeiro", "fevereiro", "março", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c) -> Column:
    """Tolerant timestamp parse to a naive wall-clock timestamp.

    ISO text with or without a zone offset keeps its wall clock (the offset is dropped,
    not applied); ``MM/dd/yyyy`` is read month-first; junk gives null.
    """
    s = _col(c).cast("string")
    iso = s.try_cast("timestamp_ntz")
    us = F.try_to_timestamp(s, F.lit("MM/dd/yyyy")).cast("timestamp_ntz")
    return F.coalesce(iso, us)


def days_between(end, start) -> Column:
    """Whole days from ``start`` to ``end``, rounded down (-1.5 days gives -2)."""
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return F.floor(micros / F.lit(86_400_000_000.0)).cast("int")


def weekday_monday0(d) -> Column:
    return F.weekday(_col(d))


def day_name_pt(d) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in DAY_NAMES_PT]), F.weekday(_col(d)) + 1)


def month_name_pt(d) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in MONTH_NAMES_PT]), F.month(_col(d)))


def year_month(d) -> Column:
    return F.date_format(_col(d), "yyyy-MM")


def api_date(iso) -> Column:
    """ISO date (text or date) to the ``dd/MM/yyyy`` request parameter form."""
    return F.date_format(F.to_date(_col(iso)), "dd/MM/yyyy")


def quarter_seq(year, quarter) -> Column:
    return _col(year) * 4 + _col(quarter)


def election_year(year) -> Column:
    return (_col(year) % 2 == 0).cast("int")


def quarter_label(year, quarter) -> Column:
    return F.concat(_col(year).cast("string"), F.lit("-Q"), _col(quarter).cast("string"))


def next_quarter(as_of: _dt.date | str | Column) -> tuple[Column, Column]:
    """(year, quarter) of the quarter after the one holding ``as_of``."""
    d = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    nxt = F.add_months(d, 3)
    return F.year(nxt), F.quarter(nxt)
