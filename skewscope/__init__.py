"""skewscope: imbalanced binary-classification analytics on Spark.

Every operator takes and returns a ``DataFrame``; column names are parameters.
Metrics are computed on the cluster from one distributed threshold table
(``skewscope.operators.curves``) instead of collecting predictions.
"""

__version__ = "0.1.0"
