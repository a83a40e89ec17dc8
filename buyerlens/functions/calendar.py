"""Time and birthday expressions. None of them depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from buyerlens.session import DEFAULT_TZ

DAY_MS = 86_400_000
HOUR_MS = 3_600_000

# Last day (month * 100 + day) of each sign in calendar order; the year ends in
# the sign it began with.
ZODIAC_ENDS = [
    (119, "摩羯座"),
    (218, "水瓶座"),
    (320, "双鱼座"),
    (419, "白羊座"),
    (520, "金牛座"),
    (621, "双子座"),
    (722, "巨蟹座"),
    (822, "狮子座"),
    (922, "处女座"),
    (1023, "天秤座"),
    (1122, "天蝎座"),
    (1221, "射手座"),
    (1231, "摩羯座"),
]

# First hour after each part of the day.
HOUR_BANDS = [
    (6, "凌晨"),
    (9, "早晨"),
    (12, "上午"),
    (14, "中午"),
    (18, "下午"),
    (22, "晚上"),
    (24, "夜间"),
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(millis: Column | str) -> Column:
    """Event time of a record; a missing time counts as the epoch."""
    return F.timestamp_millis(F.coalesce(_col(millis).cast("bigint"), F.lit(0).cast("bigint")))


def local_millis(millis: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """Epoch millis moved to the wall clock of ``tz``."""
    return F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(_col(millis).cast("bigint")), tz))


def local_date(millis: Column | str, tz: str = DEFAULT_TZ) -> Column:
    days = F.floor(local_millis(millis, tz) / F.lit(DAY_MS)).cast("int")
    return F.date_from_unix_date(days)


def today(tz: str = DEFAULT_TZ) -> Column:
    return local_date(F.unix_millis(F.current_timestamp()), tz)


def birthday(epoch_day: Column | str) -> Column:
    """Days since 1970-01-01 as a date."""
    return F.date_from_unix_date(_col(epoch_day).cast("int"))


def age(birth: Column | str, as_of: Column | None = None, tz: str = DEFAULT_TZ) -> Column:
    """Whole years lived; someone born on 29 February turns a year older on 1 March."""
    birth = _col(birth)
    as_of = today(tz) if as_of is None else as_of
    before_birthday = _month_day(as_of) < _month_day(birth)
    return F.year(as_of) - F.year(birth) - before_birthday.cast("int")


def decade(birth: Column | str) -> Column:
    year = F.year(_col(birth))
    return year - year % 10


def _month_day(date: Column) -> Column:
    return F.month(date) * 100 + F.dayofmonth(date)


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def zodiac(birth: Column | str) -> Column:
    """Sign of a birthday: each month holds the last days of one sign and the first of the next."""
    birth = _col(birth)
    ends = ZODIAC_ENDS[:12]
    cut = F.get(F.array(*[F.lit(end % 100) for end, _ in ends]), F.month(birth) - 1)
    first = F.get(_texts([sign for _, sign in ends]), F.month(birth) - 1)
    second = F.get(_texts([sign for _, sign in ZODIAC_ENDS[1:]]), F.month(birth) - 1)
    return F.when(F.dayofmonth(birth) <= cut, first).otherwise(second)


def hour_of_day(millis: Column | str, tz: str = DEFAULT_TZ) -> Column:
    return F.floor(F.pmod(local_millis(millis, tz), F.lit(DAY_MS)) / F.lit(HOUR_MS)).cast("int")


def hour_band(hour: Column | str) -> Column:
    """Part of the day; an hour outside 0..23 falls into the last part."""
    starts = [0, *[end for end, _ in HOUR_BANDS]]
    by_hour = [band for start, (end, band) in zip(starts, HOUR_BANDS) for _ in range(start, end)]
    hour = _col(hour).cast("int")
    late = F.lit(HOUR_BANDS[-1][1])
    return F.when(hour.isNotNull(), F.coalesce(F.get(_texts(by_hour), hour), late))


def day_partition(millis: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """``yyyyMMdd`` of the record's day."""
    return F.replace(local_date(millis, tz).cast("string"), F.lit("-"), F.lit(""))
