"""Composite report loads: raw positional cells in, typed report rows out."""
