"""Composed jobs: input bundle, score v1/v2, weight search, reports, query catalogue."""
