"""Every operator as a named query over the provided tables, with its SQL where SQL can say it."""

from tidemark.plans.catalogue import drift, evaluation, history, prep, profile, registry, scoring, streams, training
from tidemark.plans.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "drift", "evaluation", "history", "prep", "profile", "registry", "scoring", "streams", "training"]
