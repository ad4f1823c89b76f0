"""Column expressions; every function returns a Column that stays inside the JVM."""
