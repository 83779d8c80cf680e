"""Writers of batch results and of streaming micro-batches."""
