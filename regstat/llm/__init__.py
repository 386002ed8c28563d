"""Training-data operators: filters, near-duplicate and repeat removal, decontamination, encoding and sharding."""
