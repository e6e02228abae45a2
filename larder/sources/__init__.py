"""Inputs: raw CSV landing, test-table fixture mapping, bronze ingestion."""
