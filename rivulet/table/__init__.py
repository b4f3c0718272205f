"""Versioned tables over plain Parquet: change log + snapshots + history."""

from rivulet.table.versioned import VersionedTable  # noqa: F401
