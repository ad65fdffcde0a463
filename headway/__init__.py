"""Headway: transit arrival analytics as Spark DataFrame functions."""
