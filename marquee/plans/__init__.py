"""Registered queries over the test tables."""

from marquee.plans import q_chat, q_corpus, q_jobs, q_landing, q_lookups, q_silver, q_vectors, q_writes  # noqa: F401
from marquee.plans.registry import ORACLES, QUERIES  # noqa: F401
