"""Reusable plan pieces: validity-interval join (``temporal_join``), upsert family
(``upsert``)."""
