"""Confidence bands, clamps and decisions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def level3(score: Column) -> Column:
    return F.when(score >= 0.9, "high").when(score >= 0.7, "medium").otherwise("low")


def level4(score: Column) -> Column:
    return F.when(score >= 0.9, "HIGH").when(score >= 0.7, "MEDIUM").when(score >= 0.5, "LOW").otherwise("VERY_LOW")


def distribution_band(score: Column) -> Column:
    return (F.when(score >= 0.9, "high (>=0.9)").when(score >= 0.7, "medium (0.7-0.89)")
            .otherwise("low (<0.7)"))


def clamp(score: Column) -> Column:
    """Into [0, 1]; anything that is no number becomes 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(score.try_cast("double"), F.lit(0.0))))


def decision(score: Column, all_passed: Column) -> dict[str, Column]:
    """Status, auto-acceptance and review flag of a validated product."""
    failed = score < 0.85
    status = F.when(~all_passed, "requires_review").when(failed, "failed").otherwise("passed")
    return {"validation_status": status,
            "auto_accepted": all_passed & (score >= 0.95),
            "requires_review": ~all_passed | failed}
