"""Stream of transactions into the bronze table."""

from .bronze import parse_payload, read_txn_stream, start_bronze

__all__ = ["parse_payload", "read_txn_stream", "start_bronze"]
