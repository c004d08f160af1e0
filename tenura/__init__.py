"""Customer-churn analytics on Spark DataFrames."""
