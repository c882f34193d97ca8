"""Readers and writers of the formats of annotated literature."""
