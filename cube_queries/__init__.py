"""Registered queries: every operator run on cubes that Spark derives from the given tables."""
