"""The layered models: staging, enrichment, and the report tables built on them."""
