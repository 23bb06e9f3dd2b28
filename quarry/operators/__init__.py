"""Operators: DataFrame -> DataFrame building blocks."""
