"""Targets, staging and the guarded append."""
