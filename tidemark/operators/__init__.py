"""Relational building blocks: staging with observation, merge, transformations, checks."""
