"""End-to-end plans."""
