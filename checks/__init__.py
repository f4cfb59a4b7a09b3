"""Queries over the driver tables, each with an independent SQL answer where one exists."""
