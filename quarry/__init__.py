"""quarry — Spark-native exploratory analytics and model-reporting jobs.

Every public operator takes DataFrames and returns a DataFrame.  Nothing is
collected to the driver inside an operator; results stay distributed until a
sink or the caller acts on them.
"""

from quarry.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
