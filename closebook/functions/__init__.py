from closebook.functions.dates import as_date, month_of, month_start, quarter_of, year_month, year_of
from closebook.functions.numeric import millions, no_negative_zero, pct, rnd, safe_div

__all__ = [
    "as_date", "month_of", "month_start", "quarter_of", "year_month", "year_of",
    "millions", "no_negative_zero", "pct", "rnd", "safe_div",
]
