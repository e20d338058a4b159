"""Column functions: text, geometry, colour and hashes. All are built-in Spark expressions."""
