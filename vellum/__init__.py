"""Spark jobs for keeping a scholarly catalogue complete, current and searchable."""
