"""Play events: records, count-based batches, live statistics."""
