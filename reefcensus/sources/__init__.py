"""Scans: plan CSVs, worksheet grids, lookups, stored tables, pruning."""
