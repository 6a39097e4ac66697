"""Spark-native cleaning, scoring and reporting of patient-encounter records."""
