"""Operators for preparing large training corpora.

Optional: nothing else in the library imports this subpackage.  Every operator takes and returns
DataFrames; work on texts runs inside Spark tasks, intermediate tables go to the shared folder named by
``spark.checkpoint.dir``.
"""
