"""Registered queries on the driver's tables, with their SQL twins."""
