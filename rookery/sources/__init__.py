"""Batch and streaming inputs."""
