"""Entitlement gap analysis on Spark: why does an asset have no contract?

Packages
--------
sources    reading tables, nested records and file listings
functions  column expressions (predicates, arrays, scalars)
operators  frame to frame operators (joins, lookups, aggregates, skew handling)
plans      the root cause analysis and its variants, built from the operators
"""
