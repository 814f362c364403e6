"""Spark jobs for observation feeds, case counts and the stations nearest to them."""
