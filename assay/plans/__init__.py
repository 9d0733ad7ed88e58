"""The three layers, and running them in order."""
