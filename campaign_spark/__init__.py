"""campaign_spark: Spark-native campaign and ratings analytics.

Subpackages: ``sources`` (CSV/Parquet/JDBC/stages), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (the
campaign stages, the test-table binding and the query registry) and
``streaming`` (batched result delivery).
"""

__version__ = "0.1.0"
