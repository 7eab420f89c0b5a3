"""Column builders: every function here takes and returns Columns, none is a Python UDF."""
