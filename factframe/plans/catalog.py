"""Every query of the engine by name, with SQL for the same rows."""

from __future__ import annotations

from . import curve_queries, extra_queries, fact_queries, media_queries, reading_queries, record_queries, review_queries, series_queries, source_queries, text_queries

QUERIES: dict = {**record_queries.QUERIES, **fact_queries.QUERIES, **text_queries.QUERIES, **media_queries.QUERIES, **series_queries.QUERIES, **extra_queries.QUERIES, **curve_queries.QUERIES, **reading_queries.QUERIES, **review_queries.QUERIES, **source_queries.QUERIES}
ORACLES: dict = {**record_queries.ORACLES, **fact_queries.ORACLES, **text_queries.ORACLES, **media_queries.ORACLES, **series_queries.ORACLES, **extra_queries.ORACLES, **curve_queries.ORACLES, **reading_queries.ORACLES, **review_queries.ORACLES, **source_queries.ORACLES}
