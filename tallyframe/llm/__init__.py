"""Operators of a training-data pipeline: cleaning, matching, scoring, mixing and packing documents."""
