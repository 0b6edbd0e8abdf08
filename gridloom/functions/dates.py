"""Dates as serial numbers (days since 1899-12-30, times as fractions) and the calendar functions over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.base import c, fn, num, ok

EPOCH = 25569  # the serial of 1970-01-01


def day(x) -> Column:
    """The date of a serial."""
    return F.date_from_unix_date(F.floor(num(x)).cast("int") - EPOCH)


def serial(d: Column) -> Column:
    """The serial of a date or timestamp."""
    return (F.unix_date(d.cast("date")) + EPOCH).cast("double")


def from_serial(x) -> Column:
    """The timestamp of a serial, to the nearest second; sessions run in UTC."""
    seconds = F.round((num(x) - EPOCH) * 86400).cast("bigint")
    return F.timestamp_seconds(seconds)


def to_serial(t: Column) -> Column:
    """The serial of a timestamp with its time."""
    return F.unix_micros(t.cast("timestamp")) / 86400e6 + EPOCH


_clock = lambda x: F.pmod(F.round(num(x) * 86400).cast("bigint"), F.lit(86400))

fn("TODAY")(lambda: serial(F.current_date()))
fn("NOW")(lambda: to_serial(F.current_timestamp()))
fn("YEAR")(lambda x: F.year(day(x)))
fn("MONTH")(lambda x: F.month(day(x)))
fn("DAY")(lambda x: F.dayofmonth(day(x)))
fn("HOUR")(lambda x: F.floor(_clock(x) / 3600))
fn("MINUTE")(lambda x: F.floor(_clock(x) / 60) % 60)
fn("SECOND")(lambda x: _clock(x) % 60)
fn("TIME")(lambda h, m, s: ok(num(h) * 3600 + num(m) * 60 + num(s) >= 0, F.pmod(num(h) * 3600 + num(m) * 60 + num(s), F.lit(86400.0)) / 86400))
fn("EDATE")(lambda x, months: serial(F.add_months(day(x), num(months).cast("int"))))
fn("EOMONTH")(lambda x, months: serial(F.last_day(F.add_months(day(x), num(months).cast("int")))))
fn("DAYS")(lambda end, start: F.floor(num(end)) - F.floor(num(start)))
fn("ISOWEEKNUM")(lambda x: F.weekofyear(day(x)))

#: Accepted forms of dates and times in text, fixed values.
_DATES = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy")
_TIMES = ("H:m:s", "H:m", "h:m:s a", "h:m a")


@fn("DATEVALUE")
def date_value(s) -> Column:
    head = F.regexp_replace(F.trim(c(s).cast("string")), r"[ T]\d{1,2}:.*$", "")
    return F.coalesce(*[serial(F.try_to_date(head, f)) for f in _DATES])


@fn("TIMEVALUE")
def time_value(s) -> Column:
    tail = F.upper(F.regexp_extract(F.trim(c(s).cast("string")), r"(\d{1,2}:\d{1,2}(:\d{1,2})?( ?[APap][Mm])?)$", 1))
    moments = [F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), tail), F.lit("yyyy-MM-dd " + f)) for f in _TIMES]
    return F.coalesce(*[(F.hour(m) * 3600 + F.minute(m) * 60 + F.second(m)) / 86400 for m in moments])


@fn("DATE")
def date(y, m, d) -> Column:
    """Months and days roll over; years below 1900 count from 1900."""
    y = F.when(num(y) < 1900, num(y) + 1900).otherwise(num(y)).cast("int")
    return serial(F.date_add(F.add_months(F.make_date(y, F.lit(1), F.lit(1)), F.floor(num(m)).cast("int") - 1), F.floor(num(d)).cast("int") - 1))


@fn("WEEKDAY")
def weekday(x, kind: int = 1) -> Column:
    """1: Sunday is 1; 2: Monday is 1; 3: Monday is 0; 11 to 17: Monday to Sunday is 1."""
    monday = F.weekday(day(x))
    if kind == 3:
        return monday
    first = {1: 6, 2: 0}.get(kind, kind - 11)
    return F.pmod(monday - first, F.lit(7)) + 1


@fn("WEEKNUM")
def week_number(x, kind: int = 1) -> Column:
    if kind == 21:
        return F.weekofyear(day(x))
    first = {1: 6, 2: 0}.get(kind, kind - 11)
    new_year = F.pmod(F.weekday(F.trunc(day(x), "year")) - first, F.lit(7))
    return F.floor((F.dayofyear(day(x)) - 1 + new_year) / 7) + 1


@fn("DATEDIF")
def date_dif(start, end, unit: str) -> Column:
    a, b = day(start), day(end)
    short = (F.dayofmonth(b) < F.dayofmonth(a)).cast("int")
    months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a) - short
    since_month = F.datediff(b, F.add_months(a, months))
    since_year = F.datediff(b, F.add_months(a, F.floor(months / 12).cast("int") * 12))
    values = {"Y": F.floor(months / 12), "M": months, "D": F.datediff(b, a), "YM": F.pmod(months, F.lit(12)), "MD": since_month, "YD": since_year}
    return ok(b >= a, values[unit.upper()].cast("double"))


def weekend_mask(weekend=1) -> list[bool]:
    """Monday to Sunday, True for a day off; a number as in NETWORKDAYS.INTL or a text of seven 0 and 1."""
    if isinstance(weekend, str):
        return [ch == "1" for ch in weekend]
    off = {(weekend + 4) % 7, (weekend + 5) % 7} if weekend < 11 else {(weekend - 12) % 7}
    return [d in off for d in range(7)]


def _workday(d: Column, weekend, holidays: Column | None) -> Column:
    working = F.array(*[F.lit(not off) for off in weekend_mask(weekend)])
    out = F.get(working, F.weekday(d))
    return out if holidays is None else out & ~F.coalesce(F.array_contains(holidays, F.unix_date(d) + EPOCH), F.lit(False))


@fn("NETWORKDAYS.INTL")
def network_days(start, end, weekend=1, holidays=None) -> Column:
    """Working days from start to end, both counted; negative when end comes first. ``holidays``: serials as array<int>."""
    a, b = F.least(day(start), day(end)), F.greatest(day(start), day(end))
    n = F.size(F.filter(F.sequence(a, b), lambda d: _workday(d, weekend, holidays)))
    return F.when(num(start) <= num(end), n).otherwise(-n)


fn("NETWORKDAYS")(lambda start, end, holidays=None: network_days(start, end, 1, holidays))


@fn("WORKDAY.INTL")
def work_day(start, days, weekend=1, holidays=None) -> Column:
    """The serial of the n-th working day after (before) start; holidays may lengthen the search to four times."""
    n = F.floor(num(days)).cast("int")
    span = F.abs(n) * 7 + 30
    ahead = F.filter(F.sequence(F.date_add(day(start), 1), F.date_add(day(start), span)), lambda d: _workday(d, weekend, holidays))
    back = F.filter(F.sequence(F.date_sub(day(start), 1), F.date_sub(day(start), span), F.expr("interval -1 day")), lambda d: _workday(d, weekend, holidays))
    return F.when(n > 0, serial(F.get(ahead, n - 1))).when(n < 0, serial(F.get(back, -n - 1))).otherwise(F.floor(num(start)))


fn("WORKDAY")(lambda start, days, holidays=None: work_day(start, days, 1, holidays))


@fn("DAYS360")
def days360(start, end, european: bool = False) -> Column:
    a, b = day(start), day(end)
    d1, d2 = F.dayofmonth(a), F.dayofmonth(b)
    if european:
        d1, d2, shift = F.least(d1, F.lit(30)), F.least(d2, F.lit(30)), F.lit(0)
    else:
        last = a == F.last_day(a)
        d1 = F.when(last, 30).otherwise(d1)
        shift = F.when((d2 == 31) & (d1 < 30), 1).otherwise(0)
        d2 = F.when((d2 == 31) & (d1 < 30), F.lit(1)).when(d2 == 31, 30).otherwise(d2)
    return ((F.year(b) - F.year(a)) * 360 + (F.month(b) + shift - F.month(a)) * 30 + d2 - d1).cast("double")


def _leap(y: Column) -> Column:
    return (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))


def us_30_360(a: Column, b: Column) -> Column:
    """30/360 days where both ends of February count as the 30th."""
    feb = lambda d: (F.month(d) == 2) & (d == F.last_day(d))
    d1, d2 = F.dayofmonth(a), F.dayofmonth(b)
    d2 = F.when(feb(a) & feb(b), 30).otherwise(d2)
    d1 = F.when(feb(a), 30).otherwise(d1)
    d2 = F.when((d2 == 31) & (d1 >= 30), 30).otherwise(d2)
    d1 = F.least(d1, F.lit(30))
    return (F.year(b) - F.year(a)) * 360 + (F.month(b) - F.month(a)) * 30 + d2 - d1


@fn("YEARFRAC")
def year_frac(start, end, basis: int = 0) -> Column:
    """Bases 0: US 30/360, 1: actual/actual, 2: actual/360, 3: actual/365, 4: European 30/360."""
    a, b = F.least(day(start), day(end)), F.greatest(day(start), day(end))
    days = F.datediff(b, a)
    if basis == 0:
        return us_30_360(a, b) / 360
    if basis == 4:
        return days360(F.least(num(start), num(end)), F.greatest(num(start), num(end)), True) / 360
    if basis in (2, 3):
        return days / (360 if basis == 2 else 365)
    years = F.sequence(F.year(a), F.year(b))
    mean = F.aggregate(years, F.lit(0.0), lambda t, y: t + F.when(_leap(y), 366.0).otherwise(365.0)) / F.size(years)
    feb29 = lambda y: F.when(_leap(y), F.make_date(y, F.lit(2), F.lit(29)))
    inside = F.coalesce(feb29(F.year(a)).between(a, b), F.lit(False)) | F.coalesce(feb29(F.year(b)).between(a, b), F.lit(False)) | (_leap(F.year(a)) & (F.year(a) == F.year(b)))
    within = b <= F.add_months(a, 12)
    return days / F.when(within, F.when(inside, 366.0).otherwise(365.0)).otherwise(mean)
