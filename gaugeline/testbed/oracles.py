"""All oracle queries, by the name of the registered query they check."""

from __future__ import annotations

from gaugeline.testbed.payload_oracles import PAYLOADS
from gaugeline.testbed.report_oracles import GOLD
from gaugeline.testbed.scoring_oracles import SCORING

ORACLES: dict[str, str] = {**GOLD, **SCORING, **PAYLOADS}
