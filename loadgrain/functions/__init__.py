from loadgrain.functions.numbers import int_half_even, round_half_up
from loadgrain.functions.percentiles import grouped_percentiles
from loadgrain.functions.timebuckets import month_bucket, sample_time, time_bucket

__all__ = [
    "grouped_percentiles",
    "int_half_even",
    "month_bucket",
    "round_half_up",
    "sample_time",
    "time_bucket",
]
