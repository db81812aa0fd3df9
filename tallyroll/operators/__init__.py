"""DataFrame to DataFrame steps: flatten, join, roll up, number rows."""
