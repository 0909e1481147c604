"""Retail analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns DataFrames; nothing here runs a
job until an action or a sink is called.
"""
