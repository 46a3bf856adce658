"""Column-level helpers: value types and casts, uid bitmaps."""
