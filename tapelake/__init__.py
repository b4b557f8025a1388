"""Loan-performance lakehouse on PySpark: tapes -> canonical table -> marked-to-market table -> profile."""
