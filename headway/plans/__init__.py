"""Whole jobs: the end-to-end trip run and the registered queries with their SQL."""
