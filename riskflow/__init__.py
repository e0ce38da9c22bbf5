"""riskflow: card-transaction risk analytics on the public PySpark API.

Every function takes and returns Spark DataFrames; the row work runs in
executors. Time-dependent functions take an explicit ``as_of`` so results are
repeatable.
"""

from riskflow.session import cluster_settings, configure, get_session, materialize, scratch_path

__all__ = ["cluster_settings", "configure", "get_session", "materialize", "scratch_path"]
