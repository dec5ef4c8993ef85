"""Set-based operators over packet and table DataFrames."""
