"""Training-data operators and their pipeline.

Nothing else in the library imports this package.  Every operator takes a
documents-like frame (``doc_id, text`` and, where named, more columns) and
returns a frame; other columns are ignored, so extra columns never clash.
"""
