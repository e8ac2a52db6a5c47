"""Listing tables from stored page captures, as Spark jobs."""
