"""Imports every catalog module so that all queries are registered in ``CATALOG``."""

from giniflow.plans import catalog_binning, catalog_gates, catalog_models, catalog_prep, catalog_runs  # noqa: F401
from giniflow.plans.catalog import CATALOG

__all__ = ["CATALOG"]
