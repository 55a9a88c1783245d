"""Composed jobs: feature services, training, latest-value tables, reports, replay."""
