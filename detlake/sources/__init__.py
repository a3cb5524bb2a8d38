"""Sources, sinks and the Arrow seams to decoders and detectors."""
