"""The layered refresh and the query catalogue over the test tables."""
