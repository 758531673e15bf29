"""Inputs: raw logs, tab-separated records, and the tables used for checks."""
