"""bankmart: a retail-banking analytics pipeline written for Spark.

Raw CSV files are cleaned, loaded into seven base tables, shaped into staging
views, conformed dimensions and a transaction fact, checked by declared data
tests, and queried. Every step is a function from DataFrames to DataFrames.
"""
