"""Column expressions shared by the operators. Everything here stays a Spark expression."""
