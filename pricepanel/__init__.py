"""Daily price panels on Spark: loading, filling, checking, forecasting, scoring, reporting."""
