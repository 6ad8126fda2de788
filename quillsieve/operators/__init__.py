"""Table operators: each takes and returns DataFrames or Columns."""
