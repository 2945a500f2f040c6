"""Column functions (all JVM-side built-ins, so they stay inside whole-stage codegen).

Every function takes and returns a ``Column``; none runs Python per row.
"""
from spendlake.functions.text import only_digits, person_type
from spendlake.functions.numeric import parse_num, parse_bool, to_money
from spendlake.functions.dates import (
    DAY_NAMES_PT,
    MONTH_NAMES_PT,
    api_date,
    day_name_pt,
    days_between,
    election_year,
    month_name_pt,
    next_quarter,
    parse_ts,
    quarter_label,
    quarter_seq,
    weekday_monday0,
    year_month,
)
from spendlake.functions.formatting import money_text, percent_text

__all__ = [
    "only_digits", "person_type", "parse_num", "parse_bool", "to_money",
    "DAY_NAMES_PT", "MONTH_NAMES_PT", "api_date", "day_name_pt", "days_between",
    "election_year", "month_name_pt", "next_quarter", "parse_ts", "quarter_label",
    "quarter_seq", "weekday_monday0", "year_month", "money_text", "percent_text",
]
