"""Operators for training-data pipelines: decontamination, token files, secrets, near copies, personal data, repeats,
shards, languages, packing and quality rules. Nothing outside this subpackage imports it."""
