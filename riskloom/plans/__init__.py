"""Whole runs: backtest, monthly run, scenarios."""
