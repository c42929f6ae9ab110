"""netloom: table work around supply-network and cutting-stock decisions, on Spark.

Every operator is a plain function from DataFrames to DataFrames. Nothing
runs until the caller acts on the result, and no operator loops over rows
on the driver.
"""

__version__ = "0.1.0"
