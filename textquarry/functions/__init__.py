"""Column-to-Column expressions; everything here stays inside the JVM."""
