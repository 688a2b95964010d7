from tablework.functions.scalars import (PEAK_WINDOWS, as_int, clip, feed_hour,
                                        hour_of_day, peak_flag, pct,
                                        service_days)
from tablework.functions.draws import (choice_by, exponential_by, flag_by,
                                       mixture, normal_by, sample_mask,
                                       uniform_by, unit_draw)

__all__ = ["PEAK_WINDOWS", "as_int", "clip", "feed_hour", "hour_of_day",
           "peak_flag", "pct", "service_days", "choice_by", "exponential_by",
           "flag_by", "mixture", "normal_by", "sample_mask", "uniform_by",
           "unit_draw"]
