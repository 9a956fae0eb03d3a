"""ledgerscope: Spark-native analytics over ledgers of transfers between accounts.

Every operator is a function from DataFrames to DataFrames. Nothing in the
library collects a table to the driver; single-row fits (a max, a percentile,
a model) are the only values that travel back, and they come back as tiny
DataFrames that are joined or broadcast, never as Python loops over rows.
"""

__version__ = "0.1.0"
