"""Column functions: text, JSON, time and personal data."""
