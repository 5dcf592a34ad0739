"""Names of the queries registered in the given plan modules."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from placetime.plans.catalog import QUERIES  # noqa: E402

print(*(n for n, f in QUERIES.items() if f.__module__.rsplit(".", 1)[-1] in sys.argv[1:]))
