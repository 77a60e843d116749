from starling.operators import expand, fanout, keys, lookup, quality

__all__ = ["expand", "fanout", "keys", "lookup", "quality"]
