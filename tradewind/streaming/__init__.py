"""The monitor over a stream of sales."""
