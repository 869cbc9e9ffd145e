"""riskframe: Spark-native profiling, feature engineering, evaluation and drift
monitoring for labelled tables.

Every operator is a plain function ``DataFrame -> DataFrame`` whose column names
are parameters; the credit-default names in :mod:`riskframe.plans.presets` are
only the default configuration.
"""

__version__ = "0.1.0"
