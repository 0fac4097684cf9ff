"""Native column expressions. No Python UDF is registered anywhere."""
