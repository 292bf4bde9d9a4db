"""Firm-year panel jobs as Spark DataFrame transformations.

Every public function takes and returns DataFrames (or Columns) and stays
lazy; the few that run an action say so in their docstring.
"""
