"""Unit conversion, classes and exact sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Micrograms per cubic metre in one ppb of a gas, molar weights,
# spellings of the mass unit, gas constants, and alert and price classes.
UGM3_PER_PPB = {"no2": 1.88, "o3": 1.96}
MOLAR_WEIGHTS = {"so2": 64, "no2": 46, "o3": 48, "co": 28}
UGM3_UNITS = ("µg/m³", "ug/m3")
ZERO_CELSIUS_IN_KELVIN = 273.15
STANDARD_PRESSURE_KPA = 101.325
MOLAR_VOLUME_LITRES = 22.414
ALERT_CUTS = (0.25, 1.0, 2.0)
ALERT_LABELS = ("Normal", "Stress", "Alert", "Crisis")
PRICE_BINS = (
    (0, 500, "0-500"),
    (501, 1000, "501-1000"),
    (1001, 1500, "1001-1500"),
    (1501, 2000, "1501-2000"),
    (2001, 20000, ">2000"),
)


def _lookup(key: Column, table: Mapping[str, float]) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in (item[0], float(item[1]))]
    return F.try_element_at(F.create_map(*pairs), key)


def ugm3_to_ppb(gas: Column, value: Column) -> Column:
    """Micrograms per cubic metre to ppb; null for an unknown gas."""
    return value / _lookup(gas, UGM3_PER_PPB)


def ugm3_to_ppm(
    gas: Column, unit: Column, value: Column, celsius: float = 0.0, kpa: float = STANDARD_PRESSURE_KPA
) -> Column:
    """Ideal-gas conversion to ppm; other units and other parameters stay as they are."""
    kelvin = (celsius + ZERO_CELSIUS_IN_KELVIN) / ZERO_CELSIUS_IN_KELVIN
    pressure = STANDARD_PRESSURE_KPA / kpa
    weight = _lookup(gas, MOLAR_WEIGHTS)
    ppm = value / weight * F.lit(MOLAR_VOLUME_LITRES) * F.lit(kelvin) * F.lit(pressure) / F.lit(1000.0)
    return F.when(weight.isNotNull() & unit.isin(*UGM3_UNITS), ppm).otherwise(value)


def classify(
    col: Column, cuts: Sequence[float] = ALERT_CUTS, labels: Sequence[str] = ALERT_LABELS
) -> Column:
    """Label of the first cut that lies above the value; null stays null."""
    out = F.when(col.isNull(), F.lit(None))
    for cut, label in zip(cuts, labels):
        out = out.when(col < cut, label)
    return out.otherwise(labels[-1])


def bin_ranges(col: Column, ranges: Sequence[tuple[float, float, str]] = PRICE_BINS) -> Column:
    """Label of the closed range that holds the value; null in the gaps between ranges."""
    out = None
    for low, high, label in ranges:
        out = (F if out is None else out).when(col.between(low, high), label)
    return out


def scale_round(col: Column, factor: float = 1e6, digits: int = 3) -> Column:
    """Scale, then round ties to even."""
    return F.bround(col * factor, digits)


def fixed(col: Column | str, digits: int = 2) -> Column:
    """A measurement with ``digits`` decimals as a whole number of its last digit.

    Sums of whole numbers do not depend on the order in which tasks finish, so
    a retried task cannot change a result.
    """
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col * float(10**digits)).cast("bigint")


def exact_sum(col: Column | str, digits: int = 2) -> Column:
    return F.sum(fixed(col, digits)).cast("double") / float(10**digits)


def exact_mean(col: Column | str, digits: int = 2) -> Column:
    whole = fixed(col, digits)
    return F.sum(whole).cast("double") / (F.count(whole).cast("double") * float(10**digits))


def percent_of(part: Column, total: Column) -> Column:
    return F.try_divide(part, total) * 100


def percent_difference(value: Column, base: Column) -> Column:
    return F.try_divide(value - base, base) * 100
