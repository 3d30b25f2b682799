"""Windowed-signal ETL and dataset curation as Spark DataFrame operators."""
