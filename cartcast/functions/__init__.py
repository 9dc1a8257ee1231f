from .dates import days_before, elapsed_days, month_key, day_of_month  # noqa: F401
from .codes import recode, clamp_min, clip_unit, score_of_level  # noqa: F401
