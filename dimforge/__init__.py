"""dimforge: analytical data-modeling jobs on PySpark.

Every job is a function from DataFrames (plus run parameters) to a DataFrame,
declared with the DataFrame API so Catalyst/AQE choose the physical plan.
"""

from dimforge.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
