"""News-article analytics expressed as Spark DataFrame and Column operators."""

__version__ = "0.1.0"
