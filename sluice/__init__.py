"""Sluice: daily data curation on Spark.

Raw text tables go in; cleaned tables, rejects with reasons, enriched events,
summaries, quality reports and re-runnable date slices come out.  Everything
is a DataFrame operator; domain facts live in ``sluice.domains``.
"""
