"""Evapotranspiration and unit conversion expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hourly_reference_et(temp_c: Column, pressure_pa: Column, humidity: Column, wind_east: Column, wind_north: Column, short_in: Column, long_in: Column) -> Column:
    """Hourly reference evapotranspiration in mm by the FAO-56 Penman-Monteith equation, never negative.

    humidity: specific, kg/kg (above 0.02 it is taken as g/kg); wind in m/s at 10 m, brought to 2 m by the logarithmic profile; radiation
    in W/m2. Albedo 0.23, emissivity 0.98; soil heat and the denominator's wind term differ by day and night, that is by the sign of
    the net radiation. Vapour pressure is not held to saturation.
    """
    q = F.when(humidity > 0.02, humidity / 1000).otherwise(humidity)
    kpa = pressure_pa / 1000
    wind = F.hypot(wind_east, wind_north) * 4.87 / F.log(F.lit(67.8 * 10 - 5.42))
    es = 0.6108 * F.exp(17.27 * temp_c / (temp_c + 237.3))
    ea = q * kpa / (0.622 + 0.378 * q)
    slope = 4098 * es / F.pow(temp_c + 237.3, 2)
    gamma = 0.000665 * kpa
    up = 0.98 * (4.903e-9 / 24) * F.pow(temp_c + 273.15, 4)
    net = (1 - 0.23) * short_in * 0.0036 + long_in * 0.0036 - up
    day = net > 0
    soil = net * F.when(day, 0.1).otherwise(0.5)
    drag = F.when(day, 0.24).otherwise(0.96)
    et = (0.408 * slope * (net - soil) + gamma * 37 / (temp_c + 273.15) * wind * (es - ea)) / (slope + gamma * (1 + drag * wind))
    return F.greatest(et, F.lit(0.0))


def step_depth_mm(value: Column, unit: Column, hours: float) -> Column:
    """Amounts and rates in mm, kg m-2, in, mm/h or in/h as mm in a step of so many hours; null for other units."""
    return (
        F.when(unit.isin("mm", "kg m-2"), value)
        .when(unit == "in", value * 25.4)
        .when(unit == "mm/h", value * hours)
        .when(unit == "in/h", value * 25.4 * hours)
    )
