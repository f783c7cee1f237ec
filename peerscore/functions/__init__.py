"""Column expressions.  All stay on the JVM side; none is a Python UDF."""
