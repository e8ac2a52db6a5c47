"""Whole jobs: the extraction of the three site layouts, a site run, and the proof queries."""
