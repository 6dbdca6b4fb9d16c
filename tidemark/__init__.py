"""Medallion transaction analytics on Spark: land CSV files, clean, upsert, enrich, report."""
