"""The jobs: inputs to published tables."""
