"""Column functions: everything here is an expression, no job runs."""
