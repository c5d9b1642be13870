"""Listing analytics as Spark jobs: extraction, snapshot diffing, price tracking,
group medians, search and preference state over DataFrames and streams."""

from homestrata.session import build_session, configure

__all__ = ["build_session", "configure"]
