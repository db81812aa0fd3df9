"""Retail sales metrics on Spark: landing, enrichment, twelve metrics, publishing, warehouse load."""
