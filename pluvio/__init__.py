"""Station-record analytics, written as DataFrame, SQL and pyspark.ml composition."""
