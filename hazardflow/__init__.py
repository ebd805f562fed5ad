"""hazardflow: flood and wildfire analytics as plain Spark DataFrame functions.

Every operator takes a DataFrame (or Columns) and returns one, so the same code
serves batch jobs and Structured Streaming. The caller owns the session.
"""
