"""Analytics over append-only ledgers: landing, typing, run selection, history, data quality and trust, on Spark DataFrames."""
