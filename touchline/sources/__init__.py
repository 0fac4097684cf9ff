"""Readers, reference data and exports."""
