"""Imports every catalogue module so their ``@query`` registrations run."""

from cohortlens.plans import catalog_etl, catalog_load, catalog_reports, catalog_scores, catalog_stats  # noqa: F401
from cohortlens.plans.registry import REGISTRY, oracle_sql, queries  # noqa: F401
