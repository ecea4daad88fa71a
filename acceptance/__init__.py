"""Acceptance queries: every operator and job run on the shared test tables, with SQL twins."""
