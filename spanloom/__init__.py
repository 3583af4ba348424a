"""spanloom: Spark operators for span-annotated text."""

__version__ = "0.1.0"
