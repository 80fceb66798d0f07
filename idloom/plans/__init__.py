"""Whole plans: components, query catalogue, runs, command line."""
