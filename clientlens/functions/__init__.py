"""Column-level helpers (pure expressions, all JVM side)."""

from clientlens.functions.scores import score_ladder
from clientlens.functions.calendar import weekday, hour_of_day, year_of, days_between
from clientlens.functions.numeric import round_doubles, nearest_centre

__all__ = ["score_ladder", "weekday", "hour_of_day", "year_of", "days_between",
           "round_doubles", "nearest_centre"]
