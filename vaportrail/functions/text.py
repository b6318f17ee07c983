"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The four separators that Python's str.strip removes as well.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def trim_space(text: Column) -> Column:
    """Trim every kind of Unicode white space; Spark's own ``trim`` removes blanks only."""
    return F.btrim(text, F.lit(UNICODE_SPACE))


def strip_callsign(text: Column) -> Column:
    """Ingest rule: missing or empty gives NULL, white space alone gives ``''``."""
    return F.when(F.length(text) > 0, F.btrim(text, F.lit(UNICODE_SPACE + SEPARATORS)))


def carrier_code(callsign: Column) -> Column:
    """First three letters of the callsign in upper case, or a fixed label when too short."""
    code = trim_space(callsign)
    return F.when(F.length(code) >= 3, F.upper(F.substring(code, 1, 3))).otherwise(
        F.lit("UNKNOWN_CARRIER")
    )
