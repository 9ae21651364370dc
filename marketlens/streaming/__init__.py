"""The location report over an unbounded feed of orders."""
