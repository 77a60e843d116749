from starling.functions import columns, hashing, money

__all__ = ["columns", "hashing", "money"]
