from .columns import (clip_lower, fill_default, round_half_up_ratio,
                      split_hash, stockout_flag, strip_lower, tolerant_double,
                      tolerant_int, tolerant_timestamp)

__all__ = [
    "clip_lower", "fill_default", "round_half_up_ratio",
    "split_hash", "stockout_flag", "strip_lower", "tolerant_double",
    "tolerant_int", "tolerant_timestamp",
]
