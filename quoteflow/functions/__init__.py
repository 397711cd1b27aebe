"""Column functions: symbol clean-up and time normalisation."""

from quoteflow.functions.text import clean_symbol, is_present
from quoteflow.functions.times import (
    epoch_to_timestamp,
    is_falsy,
    micros_since_epoch,
    parse_iso,
    time_order,
    truthy_or,
    with_quote_time,
)

__all__ = [
    "clean_symbol",
    "epoch_to_timestamp",
    "is_falsy",
    "is_present",
    "micros_since_epoch",
    "parse_iso",
    "time_order",
    "truthy_or",
    "with_quote_time",
]
