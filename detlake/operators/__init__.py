"""DataFrame transforms: alignment, keys, datasets, samples, quality, metrics, matching, timelines."""
