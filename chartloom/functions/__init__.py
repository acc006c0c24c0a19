"""Column functions: text, dates and arrays. All of them stay on the JVM side."""
