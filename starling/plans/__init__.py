from starling.plans import analytics, charts, checks, dims, facts, keysets, star, views

__all__ = ["analytics", "charts", "checks", "dims", "facts", "keysets", "star", "views"]
