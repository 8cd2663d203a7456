"""The full query catalog: importing this module registers every query."""

from quayside.plans import (analytics, exports, file_forms, records, roster,  # noqa: F401
                            text_times)
from quayside.plans.registry import ORACLES, QUERIES  # noqa: F401
