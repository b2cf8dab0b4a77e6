"""Column expressions shared by the jobs; all are built-in, none is a UDF."""
