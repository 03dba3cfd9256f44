"""Reference SQL for DuckDB, written independently of the Spark operators."""
