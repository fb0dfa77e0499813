"""Reusable DataFrame operators: staging, rollups, rolling windows, ordered scans, quality checks."""
