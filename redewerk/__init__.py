"""redewerk: a PySpark engine for preparing and checking conversational text corpora."""

__version__ = "0.1.0"
