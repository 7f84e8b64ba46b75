"""Spark-native operators that link market news to price moves.

Every operator is a function from DataFrames to a DataFrame; nothing here starts
a session, collects data tables or hints a physical strategy.
"""
