"""Date helpers.  Times are zone-less midnights, so no session zone can shift a day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_SECOND = 1_000_000


def midnight(day: Column) -> Column:
    """The timestamp at the start of ``day``."""
    return day.cast("timestamp_ntz")


def lookback_start(as_of: date, months: int) -> Column:
    """``as_of`` less ``months``, clamped to the month's end; folds to a literal."""
    return F.add_months(F.lit(as_of), -months)


def day_sequence(low: Column, high: Column) -> Column:
    """Every date from ``low`` to ``high`` inclusive; null when the bounds are reversed."""
    return F.when(low <= high, F.sequence(low, high, F.expr("INTERVAL 1 DAY")))


def order_value(column: Column, data_type: T.DataType) -> Column:
    """A bigint that orders the same way as ``column``."""
    if isinstance(data_type, T.TimestampNTZType):
        seconds = F.hour(column) * 3600 + F.minute(column) * 60
        fraction = (F.extract(F.lit("SECOND"), column) * MICROS_PER_SECOND).cast("bigint")
        days = F.datediff(column, F.lit(date(1970, 1, 1))).cast("bigint")
        return days * MICROS_PER_DAY + seconds.cast("bigint") * MICROS_PER_SECOND + fraction
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(data_type, T.DateType):
        return F.datediff(column, F.lit(date(1970, 1, 1))).cast("bigint")
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("bigint")
    raise TypeError(f"no bigint order for {data_type.simpleString()}")
