"""Jobs composed of operators, and their binding to the given tables."""
