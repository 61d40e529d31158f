"""Landed files in, layered tables out."""
