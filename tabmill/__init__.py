"""tabmill: Spark-native preparation, modelling, evaluation and explanation of tabular data.

Every operator takes and returns a ``pyspark.sql.DataFrame``; all passes over data
run on executors.  The driver only ever holds bounded values (level lists, task
lists, partition offsets, fitted model objects, grid points).
"""

__version__ = "0.1.0"
