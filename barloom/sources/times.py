"""Time columns of any type to one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are read by the first of these that fits; without a zone they are in the session's.
FORMATS = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "yyyyMMdd")


def epoch_micros(number: Column) -> Column:
    """Microseconds since 1970 of a number of seconds, or of milli-, micro- or nanoseconds, told by its size from 1e12, 1e15 and 1e18 on."""
    size, nanos = F.abs(number), number.cast("decimal(20,0)") / F.lit(1000).cast("decimal(4,0)")  # exact, as doubles are not at this size
    return F.when(size >= 10**18, F.floor(nanos).cast("long")).when(size >= 10**15, number.cast("long")).when(size >= 10**12, number.cast("long") * 1000).otherwise(F.floor(number * 1_000_000).cast("long"))


def as_time(column: str, kind: T.DataType, first_year: int = 1970, last_year: int = 2100) -> Column:
    """A timestamp from a time, a date, a number (epoch_micros) or a text (digits of ten or more places as a number, else by FORMATS). What can't be read,
    and what lies outside first_year up to but not including last_year, is null."""
    c = F.col(column)
    if isinstance(kind, T.StringType):
        text = F.trim(c)
        digits = text.rlike(r"^-?\d{10,19}$")
        out = F.when(digits, F.timestamp_micros(epoch_micros(F.when(digits & (F.abs(text.try_cast("double")) < 9.2e18), text).try_cast("long")))).otherwise(F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in FORMATS)))
    elif isinstance(kind, T.NumericType):
        sane = F.when(F.abs(c.cast("double")) < 9.2e18, c.cast("long" if isinstance(kind, T.IntegralType) else "double"))  # NaN is above
        out = F.timestamp_micros(epoch_micros(sane))
    else:
        out = c.cast("timestamp")
    return F.when((F.year(out) >= first_year) & (F.year(out) < last_year), out)
