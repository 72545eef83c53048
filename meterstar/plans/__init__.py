"""End-to-end jobs: build the master, score it, forecast from it."""
