"""Spark-native preparation and analysis of civil-registration microdata."""
