"""Tamarack: a PySpark-native engine for document extraction and text-corpus analytics."""

__version__ = "0.1.0"
