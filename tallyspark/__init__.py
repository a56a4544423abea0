"""Tallyspark: a PySpark-native engine for league statistics and bulk data preparation."""
