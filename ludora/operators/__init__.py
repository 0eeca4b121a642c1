"""Relational operators: cleaning, profiling, splitting, candidates, scoring, metrics."""
