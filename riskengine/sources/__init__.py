"""Readers and writers (CSV, columnar files, models) and the driver-table mapping."""
