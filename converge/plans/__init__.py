"""Registered queries by subject, each with the DuckDB SQL that says the same."""
