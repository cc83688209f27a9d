"""Column functions: every one maps Columns to a Column and runs in the JVM unless it says otherwise."""
