"""tillwork: a retail warehouse, experiment and reporting library for PySpark.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing runs until the caller asks for an action, except where a
function writes a table or starts a stream and says so.
"""
