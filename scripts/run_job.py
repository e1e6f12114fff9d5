"""spark-submit driver script: ``spark-submit --py-files shelfroll.zip scripts/run_job.py <params.json> …``."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfroll.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
