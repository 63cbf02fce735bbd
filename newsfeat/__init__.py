"""newsfeat: a PySpark-native engine for preparing, describing and classifying
collections of news-like text documents.

Every operator takes and returns DataFrames and runs distributed; see
"""

__version__ = "0.1.0"
