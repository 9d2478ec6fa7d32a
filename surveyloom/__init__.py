"""Integration of multi-survey biological sampling data on Spark."""
