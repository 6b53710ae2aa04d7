"""All named queries of the library."""

from segloom.plans import acceptance, audits, ingest, rewrites, states, streams, texts, timelines
from segloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "acceptance", "audits", "ingest", "rewrites", "states", "streams", "texts", "timelines"]
