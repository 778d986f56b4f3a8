"""Budget models on Spark ML."""
