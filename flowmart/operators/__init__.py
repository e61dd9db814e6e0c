"""DataFrame operators: each takes DataFrames and returns a lazy DataFrame."""

from flowmart.operators import catalog, conform, enrich, metrics, ordering, quality, reshape

__all__ = ["catalog", "conform", "enrich", "metrics", "ordering", "quality", "reshape"]
