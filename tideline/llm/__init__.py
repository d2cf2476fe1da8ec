"""Training-data operators: ten large-scale text, vector and media jobs on Spark."""
