"""Source tables of the warehouse, derived by Spark from the given test tables."""
