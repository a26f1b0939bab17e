"""As-of features, diagnostics and forecast-error reports on Spark DataFrames."""
