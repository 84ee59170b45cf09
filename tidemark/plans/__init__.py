"""Business queries composed from the operators, and the table sync."""
