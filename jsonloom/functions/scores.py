"""Score formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quality_score(total: Column, errors: Column, warnings: Column) -> Column:
    """100 minus the share of the possible penalty: 2 per error, 0.5 per warning, 2 per check at most."""
    worst = 2.0 * total
    penalty = F.least(2.0 * errors + 0.5 * warnings, worst)
    return F.when(total == 0, F.lit(100.0)).otherwise(100.0 - penalty / worst * 100)


def arrival_score(duplicates: Column, orphans: Column, violations: Column, unreadable: Column) -> Column:
    penalty = 1.0 * duplicates + 5.0 * orphans + 3.0 * violations + 10.0 * unreadable
    return F.greatest(F.lit(0.0), 100.0 - penalty)


def schema_complexity(tables: Column, fields: Column, foreign_keys: Column) -> Column:
    return F.least(F.lit(100.0), 10.0 * tables + 2.0 * fields + 5.0 * foreign_keys)


def efficiency(generation_rate: Column, processing_rate: Column, quality: Column) -> Column:
    return F.least(F.lit(100.0), 0.3 * generation_rate + 0.3 * processing_rate + 0.4 * quality)


def overall_score(quality: Column, passed: Column, efficiency_score: Column) -> Column:
    return 25.0 + 0.4 * quality + F.when(passed, F.lit(20.0)).otherwise(F.lit(0.0)) + 0.15 * efficiency_score


def recommendation(score: Column) -> Column:
    return (
        F.when(score > 90, F.lit("Excellent"))
        .when(score > 70, F.lit("Good"))
        .otherwise(F.lit("Poor"))
    )


def share(part: Column, whole: Column) -> Column:
    """part / whole with the denominator kept at 1 or more."""
    return part / F.greatest(whole, F.lit(1))
