"""Training-data operators: quality, deduplication, decontamination, extraction, scoring."""
