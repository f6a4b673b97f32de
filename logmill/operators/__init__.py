"""DataFrame to DataFrame steps and reports."""
