"""Weather quantities as column expressions: unit conversion, humidity, wind, angles, sun height, ids.

Missing values are nulls. A unit that is not known raises ValueError while the plan is built; so does an amount or
energy unit without its time step.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accepted unit spellings, in small letters and without blanks; what to add (temperature) or multiply by.
TEMPERATURE_UNITS = {"k": -273.15, "kelvin": -273.15, "degc": 0.0, "°c": 0.0, "c": 0.0, "celsius": 0.0}
WIND_UNITS = {"m/s": 1.0, "ms-1": 1.0, "m.s-1": 1.0, "km/h": 1 / 3.6, "kmh-1": 1 / 3.6, "km.h-1": 1 / 3.6}
RAIN_UNITS = {"kgm-2s-1": 3600.0, "mms-1": 3600.0, "mm/s": 3600.0, "mmd-1": 1 / 24, "mm/day": 1 / 24, "mmday-1": 1 / 24, "mm/h": 1.0, "mmh-1": 1.0}
RADIATION_UNITS = {"wm-2": 1.0, "w/m2": 1.0, "w.m-2": 1.0, "kwm-2": 1000.0, "kw/m2": 1000.0, "kw.m-2": 1000.0}
ENERGY_UNITS = ("jm-2", "j/m2", "j.m-2")
HUMIDITY_UNITS = {"%": 1.0, "percent": 1.0, "percentage": 1.0, "pct": 1.0, "1": 100.0, "fraction": 100.0, "dimensionless": 100.0, "unitless": 100.0}
#: Mean Earth radius in km, solar constant in W m-2.
EARTH_KM = 6371.0088
SOLAR_MAX = 1361.0


def finite(x: Column) -> Column:
    """x, or null where it is NaN or infinite; comparisons with NaN would otherwise hold."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def _known(units: str, table: dict, what: str):
    short = _short(units)
    if short not in table:
        raise ValueError(f"unknown unit of {what}: {units!r}")
    return table[short]


def _short(units: str | None) -> str:
    return (units or "").lower().replace(" ", "").replace("²", "2")


def to_celsius(x: Column, units: str) -> Column:
    return x + F.lit(_known(units, TEMPERATURE_UNITS, "temperature"))


def to_ms(x: Column, units: str) -> Column:
    return x * F.lit(_known(units, WIND_UNITS, "wind"))


def to_mmh(x: Column, units: str, step_hours: float | None = None) -> Column:
    """A rain rate; plain amounts (mm) are spread over step_hours."""
    if _short(units) == "mm":
        if not step_hours:
            raise ValueError("an amount of rain needs its time step")
        return x / F.lit(float(step_hours))
    return x * F.lit(_known(units, RAIN_UNITS, "precipitation"))


def to_wm2(x: Column, units: str, step_seconds: float | None = None) -> Column:
    """Radiation flux; energies (J m-2) are spread over step_seconds."""
    if _short(units) in ENERGY_UNITS:
        if not step_seconds:
            raise ValueError("an energy needs its time step")
        return x / F.lit(float(step_seconds))
    return x * F.lit(_known(units, RADIATION_UNITS, "radiation"))


def to_percent(x: Column, units: str) -> Column:
    """Relative humidity in percent, kept within 0..100; null stays null. Beyond -1..101 a value raises an error when it is read."""
    scale = _known(units, HUMIDITY_UNITS, "humidity")
    y = x * F.lit(scale)
    y = F.when(~y.between(-1, 101), F.raise_error(F.concat(F.lit("humidity out of range: "), y.cast("string"))).cast("double")).otherwise(y)
    return F.when(y.isNotNull(), F.least(F.greatest(y, F.lit(0.0)), F.lit(100.0)))


def infer_temperature_unit(df: DataFrame, col: str, kelvin_above: float = 100.0) -> DataFrame:
    """One row (unit): K if the median finite value is above kelvin_above, else degC. An aggregate, no driver loop."""
    return df.agg(F.when(F.median(finite(F.col(col))) > kelvin_above, "K").otherwise("degC").alias("unit"))


def infer_humidity_unit(df: DataFrame, col: str) -> DataFrame:
    """One row (unit): fraction up to 1.01, % up to 101, else invalid."""
    top, low = F.max(finite(F.col(col))), F.min(finite(F.col(col)))
    return df.agg(F.when(low < -1, "invalid").when(top <= 1.01, "fraction").when(top <= 101, "%").otherwise("invalid").alias("unit"))


def magnus_rh(t_k: Column, td_k: Column) -> Column:
    """Relative humidity in percent from temperature and dew point in kelvin."""
    pressure = lambda c: 6.112 * F.exp(17.67 * c / (c + 243.5))
    rh = 100.0 * pressure(td_k - 273.15) / pressure(t_k - 273.15)
    return F.when(rh.isNotNull(), F.least(F.greatest(rh, F.lit(0.0)), F.lit(100.0)))


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def lon_180(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def lon_360(lon: Column) -> Column:
    """Longitude in [0, 360)."""
    return F.pmod(lon, F.lit(360.0))


def cap_radiation(x: Column) -> Column:
    """Impossibly high radiation counts as none."""
    return F.when(x > SOLAR_MAX, 0.0).otherwise(x)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def solar_elevation(lat: Column, lon: Column, t: Column) -> Column:
    """Height of the sun in degrees at UTC time t, by Spencer's series for declination and equation of time."""
    g = 2 * math.pi * (F.dayofyear(t) - 1) / 365.0
    # fixed values: coefficients of both series
    dec = 0.006918 - 0.399912 * F.cos(g) + 0.070257 * F.sin(g) - 0.006758 * F.cos(2 * g) + 0.000907 * F.sin(2 * g) - 0.002697 * F.cos(3 * g) + 0.00148 * F.sin(3 * g)
    eot = 229.18 * (0.0000075 + 0.001868 * F.cos(g) - 0.032077 * F.sin(g) - 0.014615 * F.cos(2 * g) - 0.04089 * F.sin(2 * g))
    minutes = F.hour(t) * 60 + F.minute(t) + eot + 4 * lon
    angle = F.radians(minutes / 4 - 180)
    s = F.sin(F.radians(lat)) * F.sin(dec) + F.cos(F.radians(lat)) * F.cos(dec) * F.cos(angle)
    return F.degrees(F.asin(F.least(F.greatest(s, F.lit(-1.0)), F.lit(1.0))))


def fixed4(x: Column) -> Column:
    """A number of at most three digits before the point with four decimals, rounded by its exact binary value (half to even).

    The nearest multiple is taken first; then 20000 * |x|, as a whole number of 2 ** -52 (below 1: 2 ** -62; below 0.001: 2 ** -72), is
    held against the two points half way to its neighbours.
    """
    y = F.abs(x)
    n = F.round(y * 1e4).cast("bigint")
    by_size = lambda f: F.when(y >= 1, f(52)).when(y >= 1 / 1024, f(62)).otherwise(f(72))
    exact = F.floor(y * by_size(lambda k: F.lit(float(1 << k)))).cast("bigint").cast("decimal(20,0)") * F.lit(20000).cast("decimal(5,0)")
    unit = by_size(lambda k: F.lit(Decimal(1 << k)).cast("decimal(22,0)"))
    half = lambda d: (2 * n + d).cast("decimal(10,0)") * unit
    odd = F.pmod(n, F.lit(2)) == 1
    up = (exact > half(1)) | ((exact == half(1)) & odd)
    down = (exact < half(-1)) | ((exact == half(-1)) & odd)
    n = n + up.cast("int") - down.cast("int")
    return F.format_string("%s%d.%04d", F.when(x < 0, "-").otherwise(""), F.floor(n / 10000), F.pmod(n, F.lit(10000)))


def station_id(scenario: Column, tech: Column, lon: Column, lat: Column) -> Column:
    """20 hex digits of sha1('scenario|tech|lon|lat'), coordinates with four decimals, longitude in [-180, 180).

    Null for an unknown scenario or technology, or coordinates that are missing or impossible.
    """
    ok = scenario.isin("ssp126", "ssp245", "ssp585") & tech.isin("wind", "solar") & (F.abs(lat) <= 90) & finite(lon).isNotNull()
    return F.when(ok, F.left(F.sha1(F.concat_ws("|", scenario, tech, fixed4(lon_180(lon)), fixed4(lat))), F.lit(20)))
