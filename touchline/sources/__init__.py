"""Readers: CSV, Parquet lake, JDBC and Kafka."""
