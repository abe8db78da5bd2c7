"""Retail analytics and recommendation as plain DataFrame functions on Spark."""
