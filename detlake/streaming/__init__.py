"""Streaming forms of a few operators (an extension: the batch engine is the reference for results)."""
