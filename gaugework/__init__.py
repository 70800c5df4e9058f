"""Evidence-based scoring on Spark DataFrames: missing is never zero, history is strictly prior."""
