"""``python -m bazaar <raw folder> <warehouse folder> [database]``: one daily run."""

from __future__ import annotations

import logging
import sys

from bazaar.plans.daily import run_daily
from bazaar.session import build_session

logging.basicConfig(level=logging.INFO)
if len(sys.argv) not in (3, 4):
    sys.exit(__doc__)
session = build_session("daily")
for table, rows in run_daily(session, *sys.argv[1:]).items():
    print(f"{table}\t{rows}")
session.stop()
