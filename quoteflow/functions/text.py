"""Clean-up of ticker symbols."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as whitespace in Unicode or is one of the four
# ASCII separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def is_present(symbol: Column) -> Column:
    """Neither NULL nor empty. Blanks count as present: they are cleaned later."""
    return symbol.isNotNull() & (symbol != "")


def clean_symbol(symbol: Column) -> Column:
    """Strip whitespace of any kind from both ends, then upper-case."""
    return F.upper(F.btrim(symbol, F.lit(WHITESPACE)))
