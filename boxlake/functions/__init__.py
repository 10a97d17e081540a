"""Column to Column functions; everything stays in JVM expressions."""
