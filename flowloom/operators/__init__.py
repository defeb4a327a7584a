"""DataFrame operators of the flow domain; each takes and returns DataFrames."""
