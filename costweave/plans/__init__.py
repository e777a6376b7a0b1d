"""Whole jobs: the monthly refresh, the reporting layer and the query catalogue."""
