"""A PySpark engine that turns text into relational facts and analytical tables."""
