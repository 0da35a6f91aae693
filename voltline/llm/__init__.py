"""Operators for preparing training text (documents, pages) with Spark; nothing else in the library imports this."""
