"""Data jobs composed from the operators. Each takes DataFrames and returns one DataFrame; none runs an action."""
