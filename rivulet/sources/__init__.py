"""Scans: driver tables, raw files, change logs, catalog tables, JDBC."""
