"""strideframe — position-tracking analytics as Spark DataFrame plans.

Every operator takes DataFrames and returns a DataFrame built from
built-in Spark expressions (no Python UDFs on the hot path).  Jobs in
``strideframe.plans`` compose the operators into the user-facing
reports (distance, possession, clutch efficiency, data-quality checks,
linear scoring).
"""

from strideframe.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
__version__ = "0.1.0"
