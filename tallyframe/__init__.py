"""Tabular statistics, text counting, splitting and Spark ML work as DataFrame functions."""
