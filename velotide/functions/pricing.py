"""Supply gaps and the two pricing rules.

Two rules exist and differ on purpose.  The *analysis* rule prices every
historical station-hour and derives the zone from the multiplier; the
*decision* rule answers a single request, derives the zone from the branch
taken and explains itself.  They also use a different slope when bikes and
docks are short at once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from velotide.functions.rounding import exact_round, scaled_round, whole

BASE_PRICE_USD = 4.49

# Stock assumed for a station of unknown capacity.
UNKNOWN_STOCK = 15

# Thresholds on the gap ratios: fixed values of the pricing policy.
SHORT_BOTH, SHORT_ONE, AMPLE = -0.5, -0.3, 0.5

# Explanations: fixed texts.
REASONS = {
    "both short": "Double shortage: bikes %d short, docks %d short. Heavy surge applied.",
    "bikes short": "Bike shortage: predicted demand exceeds supply by %d. "
    "Surge applied to encourage nearby station use.",
    "docks short": "Dock congestion: predicted returns exceed empty docks by %d. "
    "Mild surge to discourage returns here.",
    "both ample": "Double surplus: bikes and docks both abundant. Discount applied to attract riders.",
    "bikes ample": "Bike surplus: %d extra bikes. Mild discount to encourage use.",
    "balanced": "Supply and demand balanced. Standard pricing.",
}


def estimated_bikes(capacity: Column) -> Column:
    """Half the docks are assumed occupied, at least one bike."""
    half = F.floor(capacity / 2).cast("int")
    return F.when(capacity <= 0, F.lit(UNKNOWN_STOCK)).otherwise(
        F.greatest(F.lit(1), half)
    )


def estimated_docks(capacity: Column, bikes: Column) -> Column:
    return F.when(capacity <= 0, F.lit(UNKNOWN_STOCK)).otherwise(
        F.greatest(F.lit(1), capacity - bikes)
    )


def gap_ratio(gap: Column, available: Column) -> Column:
    """Gap relative to stock; stock of zero counts as one."""
    return gap.cast("double") / F.greatest(available, F.lit(1)).cast("double")


def _one_sided_multiplier(chain: Column, b: Column, d: Column) -> Column:
    """Branches both rules share, appended to an open ``when`` chain."""
    return (
        chain.when(b < SHORT_ONE, F.least(1.0 + F.abs(b) * 0.6, F.lit(1.5)))
        .when(d < SHORT_ONE, F.least(1.0 + F.abs(d) * 0.4, F.lit(1.3)))
        .when(
            (b > AMPLE) & (d > AMPLE),
            F.greatest(1.0 - F.least(b, d) * 0.25, F.lit(0.7)),
        )
        .when(b > AMPLE, F.greatest(1.0 - b * 0.15, F.lit(0.8)))
        .otherwise(F.lit(1.0))
    )


def analysis_multiplier(b: Column, d: Column) -> Column:
    """Multiplier of the analysis rule from the two gap ratios."""
    both_short = (b < SHORT_BOTH) & (d < SHORT_BOTH)
    chain = F.when(
        both_short, F.least(1.3 + (F.abs(b) + F.abs(d)) * 0.5, F.lit(2.0))
    )
    return exact_round(_one_sided_multiplier(chain, b, d), 2)


def analysis_price(multiplier: Column) -> Column:
    return scaled_round(multiplier * BASE_PRICE_USD, 2)


def analysis_zone(multiplier: Column) -> Column:
    return (
        F.when(multiplier > 1.2, "Surge")
        .when(multiplier > 1.0, "Mild Surge")
        .when(multiplier < 0.9, "Discount")
        .otherwise("Normal")
    )


def decision_multiplier(b: Column, d: Column) -> Column:
    """Multiplier of the decision rule from the two gap ratios."""
    both_short = (b < SHORT_BOTH) & (d < SHORT_BOTH)
    chain = F.when(both_short, F.least(1.3 + F.abs(b + d) / 2 * 0.7, F.lit(2.0)))
    return exact_round(_one_sided_multiplier(chain, b, d), 2)


def decision_price(multiplier: Column) -> Column:
    return exact_round(F.lit(BASE_PRICE_USD) * multiplier, 2)


def decision_zone(b: Column, d: Column) -> Column:
    return (
        F.when(b < SHORT_ONE, "Surge")
        .when(d < SHORT_ONE, "Mild Surge")
        .when(b > AMPLE, "Discount")
        .otherwise("Normal")
    )


def decision_reason(b: Column, d: Column, bike_gap: Column, dock_gap: Column) -> Column:
    """Explanation shown to the rider, with gaps as whole numbers."""
    bikes_short, docks_short = whole(-bike_gap), whole(-dock_gap)
    return (
        F.when(
            (b < SHORT_BOTH) & (d < SHORT_BOTH),
            F.format_string(REASONS["both short"], bikes_short, docks_short),
        )
        .when(b < SHORT_ONE, F.format_string(REASONS["bikes short"], bikes_short))
        .when(d < SHORT_ONE, F.format_string(REASONS["docks short"], docks_short))
        .when((b > AMPLE) & (d > AMPLE), REASONS["both ample"])
        .when(b > AMPLE, F.format_string(REASONS["bikes ample"], whole(bike_gap)))
        .otherwise(REASONS["balanced"])
    )


def heuristic_demand(ts: Column) -> tuple[Column, Column]:
    """Demand assumed for an hour when there is no history at all."""
    rush = F.hour(ts).between(7, 9) | F.hour(ts).between(17, 19)
    weekend = F.dayofweek(ts).isin(1, 7)
    weekday_level = F.when(rush, 25.0).otherwise(10.0)
    bikes = F.when(weekend, weekday_level * 0.6).otherwise(weekday_level)
    return bikes, bikes * 0.9
