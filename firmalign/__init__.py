"""Reconcile a dirty payer table against a clean master with PySpark DataFrames."""
