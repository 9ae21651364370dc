"""Sales, pricing, session and location analytics as plain PySpark DataFrame functions."""
