"""Units (rounded half to even), angles, circular statistics, and the speed and leeway models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Knots in a metre a second, and kelvins at 0 degrees Celsius: fixed values.
KNOTS = 1.94384
KELVIN = 273.15


def rad_to_deg(x: Column) -> Column:
    return F.bround(F.degrees(x), 2)


def ms_to_knots(x: Column) -> Column:
    return F.bround(x * KNOTS, 3)


def kelvin_to_celsius(x: Column) -> Column:
    return F.bround(x - KELVIN, 2)


def per_minute_to_per_second(x: Column) -> Column:
    return x / 60


def fold_180(x: Column) -> Column:
    """0..360 to -180..180; 180 itself stays."""
    return F.when(x > 180, x - 360).otherwise(x)


def circular_mean(degrees: Column) -> Column:
    """Mean bearing in 0..360 of the group."""
    return F.pmod(F.round(circular_mean_signed(degrees), 6) + 360, F.lit(360.0))


def circular_mean_signed(degrees: Column) -> Column:
    """Mean angle in -180..180 of the group."""
    r = F.radians(degrees)
    return F.degrees(F.atan2(F.avg(F.sin(r)), F.avg(F.cos(r))))


def resultant_length(degrees: Column) -> Column:
    """Agreement of the group's angles, 0 to 1."""
    r = F.radians(degrees)
    return F.sqrt(F.pow(F.avg(F.sin(r)), 2) + F.pow(F.avg(F.cos(r)), 2))


def adjusted_speed(stw: Column, factor: Column) -> Column:
    return stw * F.coalesce(factor, F.lit(1.0))


def corrected_speed(adjusted: Column, heel: Column) -> Column:
    """Speed through water less what the sensor misreads at low speed and under heel. The coefficients are fixed values."""
    v = F.abs(adjusted)
    low = 2.2162 * (1 - F.exp(-F.least(v / 0.5, F.lit(700.0)))) / (1 + F.exp(F.least(v / 1.2698, F.lit(700.0))))
    side = F.when(heel < 0, 0.1294).otherwise(0.1166)
    lean = F.pow(F.least(F.abs(F.coalesce(heel, F.lit(0.0))), F.lit(30.0)) / 20, F.lit(2))
    return v + low - side * lean * (1 - F.exp(-F.least(v / 1.0, F.lit(700.0))))


def leeway(heel: Column, corrected: Column) -> Column:
    """Leeway angle, to the heeled side, 15 at most; null where speed is, though least and greatest skip nulls."""
    drift = F.least(8.080 * F.abs(heel) / F.pow(F.greatest(corrected, F.lit(1.0)), F.lit(2)), F.lit(15.0))
    return F.signum(heel) * drift + 0 * corrected
