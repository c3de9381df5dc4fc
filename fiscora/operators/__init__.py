"""Set-based building blocks over DataFrames."""
