"""Scanners that find the symbols of source files."""
