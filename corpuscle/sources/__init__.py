"""Readers and writers for the files the engine exchanges."""
