"""Training-data operators (deduplication, extraction, packing, scoring, search).

Nothing else in the package imports this subpackage."""
