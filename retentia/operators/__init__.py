"""Reusable relational operators: versions, intervals, windows, merges, totals, access, checks."""
