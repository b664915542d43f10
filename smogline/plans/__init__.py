"""Transforms composed into whole jobs."""
