"""Load methods, keep-latest, running totals, reconciliation, gaps and lookups."""
