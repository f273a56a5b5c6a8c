"""Plan-level helpers: sessions and lineage."""
