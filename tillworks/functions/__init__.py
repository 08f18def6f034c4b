"""Column expressions shared by the queries."""

from tillworks.functions.calendar import as_of_time, in_month, in_year, month_of, week_of_year
from tillworks.functions.flags import count_if_null, count_when, discounted, full_price
from tillworks.functions.money import average_ticket, money_sum, percent_of, total_of_sums
from tillworks.functions.text import blank_to_null, city_key, text_key, trimmed_upper

__all__ = [
    "as_of_time",
    "average_ticket",
    "blank_to_null",
    "city_key",
    "count_if_null",
    "count_when",
    "discounted",
    "full_price",
    "in_month",
    "in_year",
    "money_sum",
    "month_of",
    "percent_of",
    "text_key",
    "total_of_sums",
    "trimmed_upper",
    "week_of_year",
]
