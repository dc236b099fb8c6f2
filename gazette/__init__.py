"""gazette: a Spark-native lakehouse for incremental article data.

Every public function takes and returns DataFrames (or Columns); nothing
is collected except one-row results such as a watermark or a size bound.
"""

__version__ = "0.1.0"
