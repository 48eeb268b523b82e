"""Contract-checked, idempotent batch tables on Spark DataFrames."""
