"""Column functions, all evaluated by Spark itself."""
