"""Column expressions. Nothing here runs a job or leaves the JVM."""
