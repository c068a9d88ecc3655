"""corpusflow: parallel-corpus preparation and measurement as Spark jobs.

Every operator takes and returns DataFrames and stays lazy unless its
docstring says it needs a small scalar (a count or a cut point) first.
"""

from corpusflow.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
