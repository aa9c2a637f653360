"""DataFrame operators that turn dirty tables and documents into one normalised, evidenced table."""
