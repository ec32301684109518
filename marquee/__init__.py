"""Catalogue, review and similarity analytics as plain DataFrame functions."""
