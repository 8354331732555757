"""claimlens: Spark-native claim mining, policy tagging and audit operators.

Every operator is a ``DataFrame -> DataFrame`` function (composable with
``DataFrame.transform``) built from Spark SQL expressions, joins, windows and
aggregations.  Python runs inside tasks only where HTML has to be parsed.
"""

__version__ = "0.1.0"
