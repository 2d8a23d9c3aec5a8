from tidewater.plans.warehouse import JOBS, Warehouse, job, materialize, path_tables
from tidewater.plans import logistics, retail, traffic  # noqa: E402,F401  (registers the jobs)

__all__ = ["JOBS", "Warehouse", "job", "materialize", "path_tables"]
