"""queries."""
