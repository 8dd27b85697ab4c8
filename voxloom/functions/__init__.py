"""Column functions: every one builds an expression and runs inside the JVM."""
