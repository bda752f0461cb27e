"""Operators of a training-data pipeline: tokenizing, scans, near copies, scores, selection."""
