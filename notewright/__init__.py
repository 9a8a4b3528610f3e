"""Notewright: a PySpark-native engine that compiles raw notes into a linked knowledge base and audits the result."""
