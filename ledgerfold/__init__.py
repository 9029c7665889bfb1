"""Organisation balances, alerts and data-quality checks as Spark DataFrames."""
