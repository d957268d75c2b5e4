"""See the modules."""
