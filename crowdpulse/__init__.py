"""Engagement and content-risk analytics as Spark DataFrame operators."""
