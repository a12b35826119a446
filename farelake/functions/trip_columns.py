"""Scalar column functions: ``Column -> Column``, all built from Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts and codes that results have to carry.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
PAYMENT_NAMES = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
FARE_EDGES = ((10, "$0-10"), (20, "$10-20"), (30, "$20-30"), (50, "$30-50"), (100, "$50-100"))
TIP_EDGES = ((10, "0-10%"), (15, "10-15%"), (20, "15-20%"), (25, "20-25%"), (30, "25-30%"))
DISTANCE_EDGES = (
    (1, "0-1 miles"),
    (2, "1-2 miles"),
    (5, "2-5 miles"),
    (10, "5-10 miles"),
    (20, "10-20 miles"),
)
FILE_SUFFIXES = (".parquet", ".csv", ".csv.gz")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(start: str | Column, end: str | Column, whole_seconds: bool = False) -> Column:
    """Fractional minutes; ``whole_seconds`` drops sub-second parts first, as the zone ETL does."""
    if whole_seconds:
        return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / F.lit(60.0)
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(60e6)


def tip_percentage(fare="fare_amount", tip="tip_amount", cap: float | None = None) -> Column:
    """Tip in percent of the fare; 0 without a positive fare, NULL without a tip."""
    pct = F.when(_col(fare) > 0, _col(tip) / _col(fare) * 100.0).otherwise(F.lit(0.0))
    return pct if cap is None else F.when(pct > cap, F.lit(float(cap))).otherwise(pct)


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0."""
    return _col(num) / F.nullif(_col(den), F.lit(0.0))


def speed_mph(distance: str | Column, minutes: str | Column) -> Column:
    """Miles per hour, 0 without a positive duration."""
    return F.when(_col(minutes) > 0, _col(distance) / (_col(minutes) / 60.0)).otherwise(F.lit(0.0))


def speed_mph_per_minute(distance: str | Column, minutes: str | Column) -> Column:
    """Like ``speed_mph`` but scaled after the division, as the exploration path computes it."""
    return F.when(_col(minutes) > 0, _col(distance) / _col(minutes) * 60.0).otherwise(F.lit(0.0))


def speed_mph_or_null(distance: str | Column, minutes: str | Column) -> Column:
    """Miles per hour, NULL unless distance and duration are positive."""
    return F.when((_col(distance) > 0) & (_col(minutes) > 0), _col(distance) / _col(minutes) * 60.0)


def fare_per_mile(fare="fare_amount", distance="trip_distance") -> Column:
    return F.when(_col(distance) > 0, _col(fare) / _col(distance))


def cost_per_mile(total="total_amount", distance="trip_distance") -> Column:
    return F.when(_col(distance) > 0, _col(total) / _col(distance)).otherwise(F.lit(0.0))


def day_of_week(ts: str | Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(_col(ts)) - 1


def weekday_from_monday(ts: str | Column) -> Column:
    """0 = Monday … 6 = Sunday."""
    return F.weekday(_col(ts))


def day_type(dow: str | Column) -> Column:
    return F.when(_col(dow).isin(0, 6), "Weekend").otherwise("Weekday")


def day_name(dow: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), (_col(dow) + 1).cast("int"))


def time_period(hour: str | Column, night_label: str = "Late Night/Early Morning") -> Column:
    h = _col(hour)
    return (
        F.when(h.between(6, 9), "Morning Rush")
        .when(h.between(10, 15), "Midday")
        .when(h.between(16, 19), "Evening Rush")
        .when(h.between(20, 23), "Evening")
        .otherwise(night_label)
    )


def hour_category(period: str | Column) -> Column:
    peak = _col(period).isin("Morning Rush", "Evening Rush")
    return F.when(peak, "Peak Hours").otherwise("Off-Peak Hours")


def payment_type_name(code: str | Column, known: int = 6) -> Column:
    """Label of a payment code; codes above ``known`` become 'Other'."""
    labels = F.lit("Other")
    for value in range(known, 0, -1):
        labels = F.when(_col(code) == value, PAYMENT_NAMES[value]).otherwise(labels)
    return labels


def _bucket(value: Column, edges, last: str) -> Column:
    label = F.lit(last)
    for edge, text in reversed(edges):
        label = F.when(value <= edge, text).otherwise(label)
    return label


def fare_bucket(fare="fare_amount") -> Column:
    return _bucket(_col(fare), FARE_EDGES, "$100+")


def tip_bucket(pct: str | Column) -> Column:
    return _bucket(_col(pct), TIP_EDGES, "30%+")


def distance_bucket(distance="trip_distance") -> Column:
    return _bucket(_col(distance), DISTANCE_EDGES, "20+ miles")


def quality_flag(distance="trip_distance", fare="fare_amount", speed="avg_speed_mph") -> Column:
    return (
        F.when((_col(distance) < 0.5) & (_col(fare) > 20), "suspicious_fare")
        .when(_col(speed) > 60, "high_speed")
        .otherwise("normal")
    )


def round_half_up(value: str | Column, digits: int) -> Column:
    """Decimal of a double, rounded half up (away from zero) on the double's shortest text, so 1.005 gives 1.01.

    Too large a value for 20 digits before the point is an error, as in a NUMERIC column.
    """
    return F.round(_col(value).cast("decimal(38,18)"), digits)


def round_stable(value: str | Column, digits: int) -> Column:
    """Rounding of means and ratios of sums, whose last bits depend on the order of addition.

    Values within 1e-9 of a tie count as the tie, so the result does not change with the number of tasks. Use
    ``round_half_up`` where a stored value must be rounded exactly.
    """
    v = _col(value)
    scale = float(10**digits)
    return F.rint((v + F.signum(v) * 1e-9) * scale) / scale


def megabytes(size: str | Column) -> Column:
    return F.round(_col(size) / F.lit(1048576.0), 2)


def has_known_suffix(key: str | Column) -> Column:
    low = F.lower(_col(key))
    hit = F.lit(False)
    for suffix in FILE_SUFFIXES:
        hit = hit | low.endswith(suffix)
    return hit


def file_name(key: str | Column) -> Column:
    return F.element_at(F.split(_col(key), "/"), -1)


def clock_key(ts: str | Column) -> Column:
    """hhmm as a number."""
    return F.hour(_col(ts)) * 100 + F.minute(_col(ts))


def calendar_key(ts: str | Column) -> Column:
    """yyyymmdd as a number."""
    return F.year(_col(ts)) * 10000 + F.month(_col(ts)) * 100 + F.dayofmonth(_col(ts))


def part_of_day(hour: str | Column) -> Column:
    h = _col(hour)
    return (
        F.when(h.between(6, 11), "Morning")
        .when(h.between(12, 16), "Afternoon")
        .when(h.between(17, 20), "Evening")
        .otherwise("Night")
    )


def is_rush_hour(hour: str | Column) -> Column:
    return _col(hour).between(7, 9) | _col(hour).between(16, 19)


def log_field(message: str | Column, pattern: str, group: int = 1) -> Column:
    """A regex group, NULL when the pattern does not match."""
    return F.nullif(F.regexp_extract(_col(message), pattern, group), F.lit(""))
