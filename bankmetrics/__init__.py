"""Bank regulatory ratios as lazy Spark DataFrame queries.

Functions take DataFrames and return DataFrames. Nothing but the command line
starts a session, and jobs run only to write or to check a size.
"""
