"""Queries over the driver's test tables and their reference SQL."""
