"""Registered queries, one module per operator family."""

from spikeloom.plans.catalog import build_q, columns_q, draws_q, growth_q, joins_q, lifecycle_q, timeline_q  # noqa: F401
