"""Cleaning jobs, star schema, marts and the two business questions."""
