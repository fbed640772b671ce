"""Readers (CSV, Parquet, JDBC) and writers (tables, reports, models, runs)."""
