"""Operators: entity resolution, fact projection, pair enumeration, invariants, reports."""
