"""Outputs: result tables, a database, and the store that streams keep up to date."""
