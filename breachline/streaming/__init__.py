"""The streaming job."""

from .job import run_detection
from .stop import ask_to_stop, await_stop

__all__ = ["ask_to_stop", "await_stop", "run_detection"]
