"""Column expressions shared by the operators; everything here stays inside the JVM."""
