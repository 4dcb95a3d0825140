"""Readers and writers: feeds, settings, fingerprints, documents, reports."""
