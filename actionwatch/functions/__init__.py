"""Column expressions. All stay inside the JVM."""
