"""Scoring of client streams with fitted models (stateless projection)."""

from propensio.streaming.scoring import score_stream, start_scoring

__all__ = ["score_stream", "start_scoring"]
