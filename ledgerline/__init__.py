"""Ledgerline: product analytics for wallet and investment events, on Spark DataFrames."""
