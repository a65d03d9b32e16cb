"""valuescope — customer value and retention analytics as Spark DataFrame operators.

Every public operator takes DataFrames (and plain parameters) and returns a
lazy DataFrame; nothing is collected to the driver except bounded
statistics (split points, a handful of model parameters, small report
tables).
"""

from valuescope.params import Params
from valuescope.session import get_spark, checkpoint_dir

__all__ = ["Params", "get_spark", "checkpoint_dir"]
