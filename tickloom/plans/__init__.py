"""Whole queries: reporting views, table adapters and the query registry."""
