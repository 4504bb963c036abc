"""Part of pagequarry, a PySpark engine that turns page collections into statement tables."""
