"""The reports: whole results built from the operators."""
