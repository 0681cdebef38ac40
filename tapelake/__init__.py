"""Spark-native movement of mainframe-style records to and from analytic tables."""
