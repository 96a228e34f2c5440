from gridpulse.functions.arrays import array_mean, ordered_values
from gridpulse.functions.bits import interleave
from gridpulse.functions.keys import surrogate_key
from gridpulse.functions.numbers import planar_distance, score_band, to_number
from gridpulse.functions.times import event_time, with_audit

__all__ = [
    "array_mean",
    "event_time",
    "interleave",
    "ordered_values",
    "planar_distance",
    "score_band",
    "surrogate_key",
    "to_number",
    "with_audit",
]
