"""Registered queries and the SQL that checks them."""

from kilnwork.plans import arrivals, inference, metrics, objects, training

QUERIES = {**inference.QUERIES, **training.QUERIES, **objects.QUERIES, **metrics.QUERIES, **arrivals.QUERIES}
ORACLES = {**inference.ORACLES, **training.ORACLES, **objects.ORACLES, **metrics.ORACLES, **arrivals.ORACLES}
