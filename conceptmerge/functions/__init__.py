"""Column functions; all stay in the JVM unless their name says python."""
