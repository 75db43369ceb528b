"""raincheck: retail sales x daily weather analytics on Spark DataFrames.

Every operator is a DataFrame -> DataFrame function built from
``pyspark.sql.functions``; I/O lives in ``raincheck.sources`` and
``raincheck.plans.pipeline``.
"""

__version__ = "0.1.0"
