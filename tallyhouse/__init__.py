"""Layered retail analytics on Spark: bronze lines, silver line items, gold star schema."""
