"""Readers and writers for the file formats the library works with."""
