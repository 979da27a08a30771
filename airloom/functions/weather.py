"""Derived weather and pollutant features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Magnus coefficients for degrees Celsius, and the Kelvin offset.
MAGNUS_A = 17.625
MAGNUS_B = 243.04
KELVIN = 273.15


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def relative_humidity(temperature: Column, dew_point: Column, kelvin: bool = False) -> Column:
    """Percent saturation; inputs in degrees Celsius unless ``kelvin`` is set."""
    if kelvin:
        temperature, dew_point = temperature - KELVIN, dew_point - KELVIN

    def pressure(t: Column) -> Column:
        return F.exp(F.try_divide(t * MAGNUS_A, t + MAGNUS_B))

    return F.try_divide(pressure(dew_point), pressure(temperature)) * 100.0


def pm_ratio(coarse: Column, fine: Column) -> Column:
    return F.try_divide(coarse, fine)


def squared_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Planar squared distance in degrees."""
    return (lat1 - lat2) * (lat1 - lat2) + (lon1 - lon2) * (lon1 - lon2)
