"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(text: Column) -> Column:
    """Strip all Unicode white space from both ends (`trim` alone strips U+0020)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def utc_now_text() -> Column:
    """The current second as `2025-01-31T12:00:00Z`, whatever the session's zone."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
