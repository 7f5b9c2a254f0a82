"""Queries over the given Parquet tables and the SQL that must give the same rows."""
