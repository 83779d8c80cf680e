"""Readers. Each returns a lazy DataFrame with an explicit schema."""

from .documents import read_profiles
from .graph_files import read_graph
from .messages import decode_stream, read_message_stream, read_txn_stream
from .tables import (
    SourceError, load_transactions, read_baseline, read_metrics, register_transactions,
)

__all__ = [
    "SourceError", "decode_stream", "load_transactions", "read_baseline", "read_graph",
    "read_message_stream", "read_metrics", "read_profiles", "read_txn_stream",
    "register_transactions",
]
