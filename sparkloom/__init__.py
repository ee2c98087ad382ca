"""User-level analytics operators on the DataFrame, SQL and Structured Streaming APIs."""
