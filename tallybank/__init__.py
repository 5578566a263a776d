"""Ledger audit and question-bank analytics as plain PySpark jobs."""
