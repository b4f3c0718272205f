"""Writers: raw landing, tables, exports."""
