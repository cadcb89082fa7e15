from paylake.functions.numeric import money_total, rate_pct_half_even, rate_pct_half_up
from paylake.functions.privacy import hash_pii, mask_name, mask_phone
from paylake.functions.timeparse import format_ts, parse_day, parse_lenient, parse_strict

__all__ = ["mask_phone", "mask_name", "hash_pii", "rate_pct_half_up",
           "rate_pct_half_even", "money_total", "parse_lenient", "parse_strict",
           "format_ts", "parse_day"]
