"""Catalog classification data work as Spark DataFrame and streaming operators."""
