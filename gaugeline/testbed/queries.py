"""All registered queries."""

from __future__ import annotations

from gaugeline.testbed.payload_queries import PAYLOADS
from gaugeline.testbed.report_queries import GOLD, Query
from gaugeline.testbed.scoring_queries import SCORING

QUERIES: dict[str, Query] = {**GOLD, **SCORING, **PAYLOADS}
