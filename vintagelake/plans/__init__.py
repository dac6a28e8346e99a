"""End-to-end marts and the registered query catalog."""
