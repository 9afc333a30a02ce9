"""Streaming forms of batch plans: an addition, the batch plans are the measure."""
