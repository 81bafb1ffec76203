"""Duolect: parallel speech-to-speech datasets built as Spark jobs."""

from duolect.config import JobConfig
from duolect.session import ship_package, workspace

__all__ = ["JobConfig", "ship_package", "workspace"]
