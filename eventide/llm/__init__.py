"""Training-data operators: scoring, filtering, de-duplication, redaction,
formatting, sharding and tokenisation of a document corpus."""
