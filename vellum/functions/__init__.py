"""Column expressions. All of them run inside the JVM."""
