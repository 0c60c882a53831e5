"""Data-quality checks. Every check is a DataFrame of check rows; nothing runs until it is read."""
