"""Monthly-snapshot feature and label stores as lazy PySpark plans."""

__version__ = "0.1.0"
