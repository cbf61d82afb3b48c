"""Airtime-lending analytics: functions from DataFrame to DataFrame on built-in Spark expressions."""
