"""DataFrame operators: tag computation, merge, bitmaps, export, ML."""
