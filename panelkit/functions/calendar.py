"""Calendar features (CAL-1..12)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_parts(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """CAL-1: year, quarter, month, day of year, day of month, day of week (1 = Sunday), hour."""
    t = F.col(ts)
    return df.withColumns({
        f"{prefix}year": F.year(t), f"{prefix}quarter": F.quarter(t), f"{prefix}month": F.month(t),
        f"{prefix}dayofyear": F.dayofyear(t), f"{prefix}dayofmonth": F.dayofmonth(t),
        f"{prefix}dayofweek": F.dayofweek(t), f"{prefix}hour": F.hour(t)})


def week_simple(d) -> Column:
    """CAL-2: week of year counted from January 1st: (day of year - 1) div 7 + 1 (not ISO)."""
    return (F.floor((F.dayofyear(_c(d)) - 1) / 7) + 1).cast("int")


def weekend(d) -> Column:
    """CAL-3: 1 on Saturday or Sunday."""
    return F.dayofweek(_c(d)).isin(1, 7).cast("int")


def business_day(d, holiday) -> Column:
    """CAL-3: 1 when neither weekend nor holiday."""
    return ((weekend(d) == 0) & (_c(holiday) == 0)).cast("int")


def _nth_weekday(year: Column, month: int, dow: int, n: int) -> Column:
    """n-th given weekday (1 = Sunday .. 7 = Saturday) of a month; n = -1 = last."""
    if n > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        shift = (F.lit(dow) - F.dayofweek(first) + 7) % 7
        return F.date_add(first, (shift + 7 * (n - 1)).cast("int"))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    back = (F.dayofweek(last) - F.lit(dow) + 7) % 7
    return F.date_sub(last, back.cast("int"))


def _observed(d: Column) -> Column:
    """A fixed-date holiday falling on Sunday is observed on Monday (Saturday: not moved)."""
    return F.when(F.dayofweek(d) == 1, F.date_add(d, 1)).otherwise(d)


# US federal holiday rules (name, month, day) for fixed dates and
# (name, month, weekday 1=Sunday, n-th; -1 = last) for floating ones.
FIXED_HOLIDAYS = [("New Year's Day", 1, 1), ("Independence Day", 7, 4),
                  ("Veterans Day", 11, 11), ("Christmas Day", 12, 25)]
FLOATING_HOLIDAYS = [("Martin Luther King Jr. Day", 1, 2, 3), ("Presidents Day", 2, 2, 3),
                     ("Memorial Day", 5, 2, -1), ("Labor Day", 9, 2, 1),
                     ("Columbus Day", 10, 2, 2), ("Thanksgiving Day", 11, 5, 4)]


def holiday_dim(spark: SparkSession, years: DataFrame, year_col: str = "year") -> DataFrame:
    """CAL-4: (date, holiday_name) for every year in ``years`` by column rules,
    Sunday holidays observed on Monday, Saturday holidays not moved."""
    y = years.select(F.col(year_col).cast("int").alias("year")).distinct()
    rows = []
    for name, m, d in FIXED_HOLIDAYS:
        rows.append(y.select(_observed(F.make_date("year", F.lit(m), F.lit(d))).alias("date"),
                             F.lit(name).alias("holiday_name")))
    for name, m, dow, n in FLOATING_HOLIDAYS:
        rows.append(y.select(_nth_weekday(F.col("year"), m, dow, n).alias("date"),
                             F.lit(name).alias("holiday_name")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def season_code(month) -> Column:
    """CAL-5: DJF = 1, MAM = 2, JJA = 3, SON = 4, anything else 5."""
    m = _c(month)
    return (F.when(m.isin(12, 1, 2), 1).when(m.isin(3, 4, 5), 2).when(m.isin(6, 7, 8), 3)
            .when(m.isin(9, 10, 11), 4).otherwise(5))


def season_name(month_name) -> Column:
    """CAL-5: season name from an English month name (NULL when unknown)."""
    m = _c(month_name)
    return (F.when(m.isin("December", "January", "February"), "winter")
            .when(m.isin("March", "April", "May"), "spring")
            .when(m.isin("June", "July", "August"), "summer")
            .when(m.isin("September", "October", "November"), "fall"))


# Relative-calendar month buckets. DAY % 340 below 10 is February,
# then 30-day buckets March .. January.
REL_MONTHS = ["February", "March", "April", "May", "June", "July", "August", "September",
              "October", "November", "December", "January"]
REL_MONTH_NUMBERS = [2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 1]
# Relative weekday names for DAY % 7 = 0 .. 6.
REL_WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _rel_month_idx(day) -> Column:
    return (F.floor(((_c(day) % 340) + 20) / 30) + 1).cast("int")


def relative_month(day) -> Column:
    """CAL-7: month name of a relative day number."""
    return F.element_at(F.array(*[F.lit(x) for x in REL_MONTHS]), _rel_month_idx(day))


def relative_month_number(day) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in REL_MONTH_NUMBERS]), _rel_month_idx(day))


def relative_weekday(day) -> Column:
    """CAL-8: weekday name of a relative day number (DAY % 7 = 0 is Monday)."""
    return F.element_at(F.array(*[F.lit(x) for x in REL_WEEKDAYS]), ((_c(day) % 7) + 1).cast("int"))


def relative_weekday_number(day) -> Column:
    """CAL-8: 1 = Monday .. 7 = Sunday."""
    return ((_c(day) % 7) + 1).cast("int")


def relative_year(week, first_cut: int = 45, second_cut: int = 93,
                  years: tuple[int, int, int] = (2017, 2018, 2019)) -> Column:
    """CAL-9: week <= 45 -> first year, 46..93 -> second, else third."""
    w = _c(week)
    return F.when(w <= first_cut, years[0]).when(w <= second_cut, years[1]).otherwise(years[2])


def cyclic_month(month, pi: float = math.pi) -> tuple[Column, Column]:
    """CAL-11: month m -> hour 2m on a 12-hour dial -> (sin, cos) of (180 - 15h)/180 * pi."""
    h = _c(month) * 2
    ang = (F.lit(180.0) - F.lit(15.0) * h) / F.lit(180.0) * F.lit(pi)
    return F.sin(ang), F.cos(ang)


def sunrise_sunset(date, lat: float, lon: float) -> tuple[Column, Column]:
    """CAL-6: sunrise/sunset (UTC hours as doubles) by the NOAA sunrise equation,
    evaluated as column math on a date column."""
    d = _c(date)
    n = F.datediff(d, F.lit("2000-01-01").cast("date")).cast("double")  # days since J2000 (noon) at noon of d
    j_star = n - F.lit(lon / 360.0)
    m_deg = (F.lit(357.5291) + F.lit(0.98560028) * j_star) % 360
    m = F.radians(m_deg)
    c = 1.9148 * F.sin(m) + 0.02 * F.sin(2 * m) + 0.0003 * F.sin(3 * m)
    lam = F.radians((m_deg + c + 180 + 102.9372) % 360)
    transit = j_star + 0.0053 * F.sin(m) - 0.0069 * F.sin(2 * lam)
    decl = F.asin(F.sin(lam) * F.sin(F.radians(F.lit(23.4397))))
    phi = math.radians(lat)
    cos_w = (F.sin(F.radians(F.lit(-0.833))) - F.lit(math.sin(phi)) * F.sin(decl)) / (F.lit(math.cos(phi)) * F.cos(decl))
    w0 = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos_w))))
    transit_h = (transit - n + 0.5) * 24.0  # hours after 00:00 UTC of d
    rise = transit_h - w0 / 360.0 * 24.0
    sets = transit_h + w0 / 360.0 * 24.0
    return rise, sets


def daylight_flag(ts, lat: float = 40.0, lon: float = -75.0, tz_offset_hours: float = -5.0) -> Column:
    """CAL-6: 1 when a local timestamp lies between sunrise and sunset."""
    t = _c(ts)
    rise, sets = sunrise_sunset(F.to_date(t), lat, lon)
    local_hour = F.hour(t) + F.minute(t) / 60.0 + F.second(t) / 3600.0
    rise_l, set_l = rise + tz_offset_hours, sets + tz_offset_hours
    return ((local_hour >= rise_l) & (local_hour <= set_l)).cast("int")


def parse_mdy(s) -> Column:
    """CAL-12: 'MM/dd/yy' -> date, two-digit years read as 20yy; NULL if invalid."""
    s = _c(s)
    return F.try_to_date(F.concat(F.lit("20"), F.substring(s, 7, 2), F.lit("-"), F.substring(s, 1, 2),
                                  F.lit("-"), F.substring(s, 4, 2)), "yyyy-MM-dd")
