"""Operators of a training-data pipeline: mixing, WARC, suffix-array dedup, quality rules, benchmark
decontamination, license scans, n-gram scoring, near-dedup, quality model and language ID.

Nothing else in the library imports this subpackage. ``registry`` holds the registered queries."""
