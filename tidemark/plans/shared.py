"""The folder that driver and executors share, for the registered queries."""

from tidemark.shared import shared_path, stored

__all__ = ["shared_path", "stored"]
