"""Micro-batch jobs."""
