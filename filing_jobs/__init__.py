"""Spark jobs for large collections of versioned XML filings."""
