"""Writing: exports and table replacement."""
