"""Column functions: everything here is a built-in expression, none is a Python UDF."""
