"""lakesieve: lake pipelines and data quality as plain Spark DataFrame operators.

Every operator takes and returns DataFrames (or Columns); sessions are passed in, never made here.
"""
