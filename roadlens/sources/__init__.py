"""Inputs: tables, files, a database, a message stream, and the text records in it."""
