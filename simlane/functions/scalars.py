"""Scalar rules for names, dates, rates and files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(url: Column) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(url, "/"), -1)


def stem(name: Column) -> Column:
    """Before the first dot."""
    return F.substring_index(name, ".", 1)


def extension(name: Column) -> Column:
    """After the last dot."""
    return F.substring_index(name, ".", -1)


def drop_last(name: Column, n: int = 4) -> Column:
    """Without the last n characters."""
    return F.when(F.length(name) > n, F.left(name, F.length(name) - n)).otherwise("")


def trailing_days(today: Column, n: int) -> Column:
    """The n - 1 days before today, latest first, as yyyyMMdd."""
    if n < 2:
        return F.array().cast("array<string>")
    days = F.sequence(F.date_sub(today, 1), F.date_sub(today, n - 1), F.expr("interval -1 day"))
    return F.transform(days, lambda d: F.date_format(d, "yyyyMMdd"))


def time_bucket(ts: Column, seconds: int = 100) -> Column:
    """Epoch seconds rounded down to a multiple."""
    return (F.floor(F.unix_timestamp(ts) / seconds) * seconds).cast("long")


def age_seconds(now: Column, ts: Column) -> Column:
    return F.unix_timestamp(now) - F.unix_timestamp(ts)


def whole_rate(rate: Column) -> Column:
    """A frame rate 'num/den' rounded down, or a whole number; null for a zero denominator and other text."""
    num, den = F.try_to_number(F.substring_index(rate, "/", 1), F.lit("9999999999")), F.try_to_number(F.split_part(rate, F.lit("/"), F.lit(2)), F.lit("9999999999"))
    return F.when(rate.rlike("^[0-9]{1,10}$"), F.floor(rate.try_cast("double"))).when(rate.rlike("^[0-9]{1,10}/[0-9]{1,10}$") & (den != 0), F.floor(num / den)).cast("long")


def form_encoded(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + "="), F.url_encode(value))


def grid_key(ix: Column, iy: Column) -> Column:
    return F.concat(ix.cast("string"), iy.cast("string"))
