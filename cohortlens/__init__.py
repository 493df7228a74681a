"""cohortlens: workforce cohort analytics, scoring and ranking metrics on Spark DataFrames."""

__version__ = "0.1.0"
