"""Counts of what became of the entries of a run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_report(outcomes: DataFrame) -> DataFrame:
    """Rows per profile, category and outcome; ``accepted`` is the appended count."""
    return outcomes.groupBy("profile", "category", "outcome").agg(
        F.count(F.lit(1)).alias("n")
    )
