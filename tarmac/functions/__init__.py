"""Column expressions. All run on the JVM; there is no row-wise Python here."""
