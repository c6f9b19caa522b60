"""Registered queries over the driver tables, each with its SQL counterpart."""

from cartloom.queries.registry import ORACLES, QUERIES  # noqa: F401
from cartloom.queries import (  # noqa: F401,E402
    documents, joins, latest, orders, parties, products, push, queue, reports, state, stock, texts,
)
