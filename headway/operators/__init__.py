"""DataFrame operators built from the column expressions and Spark ML."""
