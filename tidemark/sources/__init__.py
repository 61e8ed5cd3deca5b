"""Batch sources: the driver's parquet tables (:mod:`tables`), text files and literal
elements (:mod:`files`). Stream sources are in :mod:`tidemark.streaming.sources`."""
