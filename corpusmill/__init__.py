"""corpusmill: a PySpark-native engine for curating and scoring corpora of step-structured records."""

__version__ = "0.1.0"
