"""shelfroll — retail on-shelf-availability roll-ups as Spark DataFrame plans.

Stages: raw facts → daily staging (``build_staging``) → daily TY/LY
(``build_daily``) → weekly (``build_weekly``); ``run_job`` runs them for a
load type with partitioned Parquet output and an ORC run log.
"""

from .operators.compare import build_daily
from .operators.rollup import build_staging
from .operators.weekly import build_weekly
from .plans.jobs import run_from_file, run_job
from .sources.params import JobParams, read_params

__version__ = "0.1.0"

__all__ = ["JobParams", "build_daily", "build_staging", "build_weekly", "read_params", "run_from_file", "run_job"]
