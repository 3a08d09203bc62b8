"""Parameters of the registered queries, chosen for the words, times and rates of the driver tables so
that every operator both keeps and drops rows. The library's defaults are in ``murmur.params``."""

from __future__ import annotations

from dataclasses import replace

from murmur import params as P

LEXICON = P.Lexicon(positive=("the", "with", "for"), negative=("was", "from", "that"))
INFORMATIVE_CUES = ("of", "and", "is", "der", "de")
EMOTIONAL_CUES = ("to", "in", "are", "und", "la")
CUES = (INFORMATIVE_CUES, EMOTIONAL_CUES)
INGEST = P.IngestParams(keywords=("mit", "worth", "the"), ignore_keywords=("license", "http"), mark=1704153600.0,  # 2024-01-02 UTC
                        relevance_terms=("this", "than", "then"))
#: The same rules over everything: no newest-per-community listing and no item budget.
INGEST_ALL = replace(INGEST, newest_per_community=None, budget=None)
#: After the last event.
AS_OF = 1706745600.0  # 2024-02-01 UTC
SEARCH = P.SearchParams(ticker="MIT", timeframe="30d", as_of=AS_OF, rejects="%%%")
DASHBOARD = P.DashboardParams(as_of=AS_OF)
TICKERS = ("MIT", "GNU", "THE")
COMPANY = ("MIT", ("MIT", "GNU"))  # (literal ticker, aliases)
RUN_TIMESTAMP = "2024-01-16 09:00"
#: A week: over it some users make more requests than the limit, others do not.
QUOTA_WINDOW = 7 * 86400.0
