"""All queries of the core, with their SQL counterparts."""

from __future__ import annotations

from chatloom.plans import exports, quality, views

QUERIES = {**quality.QUERIES, **views.QUERIES, **exports.QUERIES}
ORACLE = {**quality.ORACLE, **views.ORACLE, **exports.ORACLE}
