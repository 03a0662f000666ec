"""Column helpers and row-wise DataFrame steps; everything stays inside the JVM."""
