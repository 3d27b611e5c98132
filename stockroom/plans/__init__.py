"""Jobs composed of the operators, and the queries that check them on the test tables."""
