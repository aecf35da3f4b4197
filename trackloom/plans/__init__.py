"""Jobs composed of the operators, and the queries on the driver's tables."""
