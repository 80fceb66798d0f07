"""Column expressions: names, ids, confidences."""
