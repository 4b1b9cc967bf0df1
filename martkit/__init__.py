"""PySpark toolkit for marketing-performance warehouses."""
