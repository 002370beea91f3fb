"""Builders of the silver and gold tables and the semantic layers over them.

Everything here maps DataFrames to DataFrames; only :mod:`voltmark.plans.medallion` writes.
"""
