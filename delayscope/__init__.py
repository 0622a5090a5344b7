"""Batch analytics over airline on-time records, as DataFrame-to-DataFrame functions."""

from delayscope.session import build_session

__all__ = ["build_session"]
