from tidemark.sources.tables import Sources

__all__ = ["Sources"]
