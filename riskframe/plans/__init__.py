"""Composed jobs (training/selection, batch scoring, monitoring) and presets."""
