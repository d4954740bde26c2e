"""Cleaning jobs, models, queries, indicators and data tests."""
