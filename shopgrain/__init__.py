"""Retail analytics on PySpark: staging, mart, increments, history, checks and reports."""
