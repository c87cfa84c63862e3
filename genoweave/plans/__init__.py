"""Whole analyses, the domain views over the driver's tables, and the queries on them."""
