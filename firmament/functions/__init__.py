"""Column expressions shared by the jobs; all of them are native Spark expressions."""
