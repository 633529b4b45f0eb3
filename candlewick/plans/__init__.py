"""Composed plans: the batch build, check suites and the registered queries."""
