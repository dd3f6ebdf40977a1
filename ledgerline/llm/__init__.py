"""Training-data operators: text deduplication, classification, filters and tokenisation on Spark."""
