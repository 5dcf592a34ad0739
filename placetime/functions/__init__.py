"""Column-in, Column-out functions; all run inside the JVM."""
