"""Binding of the reports to the order tables used for tests and benchmarks."""
