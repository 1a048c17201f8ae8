"""Whole jobs: layers, multi-day loads, training, evaluation."""
