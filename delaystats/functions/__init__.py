from delaystats.functions.columns import (
    hhmm_arith,
    hhmm_minutes,
    hhmm_valid,
    parse_date,
    try_int,
    valid_date,
    zero_sum,
)

__all__ = ["hhmm_arith", "hhmm_minutes", "hhmm_valid", "parse_date", "try_int", "valid_date", "zero_sum"]
