"""Operators for preparing text corpora: quality, near and substring dedup, decontamination,
secrets, URLs, tokens, packing, sharding. Nothing outside this subpackage imports it."""
