"""Replicate relational tables into a lake through change events, and prove
that the copy is right."""
