"""Composed jobs: raw ingest, conform, serve, back-fill."""
