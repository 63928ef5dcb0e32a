"""Whole jobs: the star, the daily load, the analysis page, the registered queries."""
