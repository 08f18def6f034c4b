"""Retail sales ETL and reporting, written as Spark DataFrame jobs."""
