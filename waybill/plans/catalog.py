"""All registered queries by name."""

from __future__ import annotations

from waybill.plans import counts, decoding, lifecycle, notifications

QUERIES = {**counts.QUERIES, **lifecycle.QUERIES, **notifications.QUERIES, **decoding.QUERIES}
