"""Training-data operators: dedup, filtering, mixing, tokenising, sharding.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``registry.py`` holds the thin
``opN_*`` queries and their SQL."""
