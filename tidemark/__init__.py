"""Typed DataFrame-to-DataFrame functions for search, clickstream and text data on Spark."""
