"""tessera: tabular feature engineering and stacked prediction on Spark.

Every operator is a function from DataFrames and column names to a
DataFrame (or a Column for row-wise expressions), built from Spark
expressions, aggregates and joins.
"""

__version__ = "0.1.0"
