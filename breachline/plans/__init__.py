"""The operators put together into the three jobs."""

from .jobs import detect, promote, route_detect, route_promote

__all__ = ["detect", "promote", "route_detect", "route_promote"]
