"""Imports every query module so that its registrations run."""

from playgrid.plans import q_bi, q_clans, q_core, q_fin, q_forecast, q_ingest, q_loads, q_ops, q_streams  # noqa: F401
