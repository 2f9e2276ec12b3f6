"""Operators for large-scale training-data preparation (documents, pages,
vectors).  Nothing else in the library imports this subpackage."""
