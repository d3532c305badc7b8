"""Whole analyses: metrics, balances, platform chain, dashboards, indexers."""
