"""Column expressions shared by the plans. Everything here stays inside the JVM."""
