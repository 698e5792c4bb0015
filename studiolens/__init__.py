"""studiolens: retention, sales, class and occupancy analytics for studios, on Spark.

Every operator is a plain function from DataFrames (and an explicit ``as_of``
date) to a DataFrame. Nothing is executed until the caller writes or collects.
"""
