"""Column builders: pure ``Column -> Column``, all evaluated inside the JVM."""
