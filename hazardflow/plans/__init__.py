"""Whole jobs built from the operators, and the query catalogue over the test tables."""
