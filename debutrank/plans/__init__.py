"""Whole jobs: loading the files, ranking, and the presentation tables."""
