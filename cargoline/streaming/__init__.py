"""Streaming entry points (a file-arrival trigger for the batch refresh)."""
from cargoline.streaming.trigger import refresh_on_arrival  # noqa: F401
