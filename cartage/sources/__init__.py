"""Tables, staged files and their footers as DataFrames."""
