"""Retail orders from landing files to a star schema, as Spark DataFrame jobs."""
