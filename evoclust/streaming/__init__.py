"""Stateless scoring of streaming point tables with a fitted model.

The reference has no streaming; the only streaming-safe piece is K8
(nearest-centre prediction), which is a per-row map and therefore runs
unchanged on a ``readStream`` DataFrame.
"""

from evoclust.streaming.predict import assign_stream

__all__ = ["assign_stream"]
