"""Multi-trait association-statistics processing as lazy Spark transformations."""
