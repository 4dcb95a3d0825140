"""Operators wired into whole jobs."""
