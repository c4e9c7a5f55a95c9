"""lakestrata: a layered (Bronze / Silver / Gold) banking-event pipeline on Spark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions; I/O lives in ``lakestrata.sources`` and ``lakestrata.plans``.
"""

__version__ = "0.1.0"
