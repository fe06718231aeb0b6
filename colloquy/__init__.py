"""Colloquy: a Spark-native engine for scored conversation analytics."""
