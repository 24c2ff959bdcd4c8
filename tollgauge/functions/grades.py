"""Grade order."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed


def grade_rank(grade: Column) -> Column:
    """0 for the best grade; anything unrecognised sorts last."""
    known = F.array(*[F.lit(g) for g in fixed.GRADES])
    position = F.array_position(known, F.upper(F.trim(F.coalesce(grade, F.lit("")))))
    return F.when(position > 0, position - 1).otherwise(len(fixed.GRADES)).cast("int")


def score_grade(score: Column) -> Column:
    return (
        F.when(score >= 85, "A").when(score >= 70, "B").when(score >= 55, "C")
        .when(score >= 40, "D").otherwise("F")
    )
