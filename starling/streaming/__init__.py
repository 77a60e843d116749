from starling.streaming import decode, ingest

__all__ = ["decode", "ingest"]
