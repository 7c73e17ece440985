"""Column expressions: text, dates, hashing. All of them stay inside generated code; there is no Python UDF."""
