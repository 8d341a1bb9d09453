"""Column expressions on the country-by-year panel: classes and row features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    BIG_ECONOMY_BN,
    BILLION,
    COUNTRIES_IN_RANKING,
    ECONOMY_SIZES,
    EMERGING_BN,
    EXCLUDED_CODES,
    FIRST_ML_YEAR,
    MOMENTUM_STEPS,
    OTHER,
    SMALLEST_ECONOMY,
    WORLD_REGIONS,
)
from .cleaning import banded


def billions(value: Column) -> Column:
    """P24."""
    return value / F.lit(BILLION)


def log_e(value: Column) -> Column:
    """P25: natural logarithm, null for values not above zero."""
    return F.when(value > 0, F.ln(value))


def log_10(value: Column) -> Column:
    """P25: base 10, kept apart from the natural one."""
    return F.when(value > 0, F.log10(value))


def is_country(code: Column) -> Column:
    """Not one of the codes of country groups."""
    return ~code.isin(*EXCLUDED_CODES)


def world_region(code: Column) -> Column:
    """P26. Long code lists become hash sets in the plan, so no join is needed."""
    region = F.when(F.lit(False), OTHER)
    for name, codes in WORLD_REGIONS.items():
        region = region.when(code.isin(*codes), name)
    return region.otherwise(OTHER)


def economy_size(gdp: Column) -> Column:
    """P27."""
    return banded(gdp, ECONOMY_SIZES, SMALLEST_ECONOMY)


def ranking_normalized(ranking: Column) -> Column:
    """F1."""
    return ranking / F.lit(float(COUNTRIES_IN_RANKING))


def per_rank(value: Column, ranking: Column) -> Column:
    """a value weighed by the inverse of the rank."""
    return value / (ranking + 1)


def momentum(growth: Column) -> Column:
    """score of the highest growth step that is passed; 0 for none or null."""
    score = F.when(F.lit(False), 0)
    for step, points in MOMENTUM_STEPS:
        score = score.when(growth > step, points)
    return score.otherwise(0)


def share_or_zero(part: Column, whole: Column) -> Column:
    """part / whole, 0 unless the whole is above zero."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def diversity(destinations: Column, products: Column) -> Column:
    """F5."""
    return destinations * products * F.lit(0.001)


def years_since_start(year: Column) -> Column:
    """F6."""
    return year - F.lit(FIRST_ML_YEAR)


def is_big_economy(gdp_bn: Column) -> Column:
    """F7."""
    return F.when(gdp_bn >= BIG_ECONOMY_BN, 1).otherwise(0)


def is_emerging(gdp_bn: Column) -> Column:
    """F7."""
    return F.when((gdp_bn >= EMERGING_BN) & (gdp_bn < BIG_ECONOMY_BN), 1).otherwise(0)


def turn_sin(fraction: Column) -> Column:
    """F8."""
    return F.sin(2 * F.pi() * fraction)


def turn_cos(fraction: Column) -> Column:
    """F8."""
    return F.cos(2 * F.pi() * fraction)


def stability(growth: Column) -> Column:
    """F9."""
    return F.lit(1.0) / (F.abs(growth) + 1)


def export_intensity(records: Column, gdp_bn: Column) -> Column:
    """F13."""
    return records / (gdp_bn + 1)
