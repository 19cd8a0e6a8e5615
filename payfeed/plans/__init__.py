"""Whole feeds, payload projections and the increment job."""
