"""Stored tables: numbered logs, states in leveled hash buckets, bucketed tables for joins that shuffle nothing."""
