"""Areal aggregation on Spark: gridded predictions onto nested polygons.

Every public function takes DataFrames and returns a DataFrame.
"""
