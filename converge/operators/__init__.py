"""Operators over DataFrames: projection, reconciliation, search, relevance, cutover and reports."""
