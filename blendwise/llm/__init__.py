"""Operators of a training-data pipeline, each a DataFrame-in, DataFrame-out function.

Nothing outside this folder imports it. ``queries`` holds the registered
queries; every other module is one operator or a helper.
"""
