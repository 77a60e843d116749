from starling.sources import connectors, files, literals, testbed

__all__ = ["connectors", "files", "literals", "testbed"]
