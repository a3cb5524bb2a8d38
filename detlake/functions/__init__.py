"""Column expressions: boxes, masks, labels, captions, frames, vectors."""
