"""quarry: Spark-native text, log and graph analytics.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
expressions, joins, aggregates and windows, so Catalyst plans and distributes it.
"""

__version__ = "0.1.0"
