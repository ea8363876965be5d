"""Reconciliation operators over DataFrames."""
