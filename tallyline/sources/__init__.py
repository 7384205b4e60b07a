"""Readers and writers: catalog CSV, event log, topic, read-model tables."""
