"""Periodic loan-book risk reporting as Spark jobs."""
