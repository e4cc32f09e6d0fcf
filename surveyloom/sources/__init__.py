"""Readers and writers: survey tables, their metadata, dictionaries, growth tables, reports."""
