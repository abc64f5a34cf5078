"""Print the physical plan of registered queries: python tools/explain.py KEY [KEY...]

Set SF_DIR to choose the scale factor (default sf0.1); MODE=formatted|simple.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans.catalog import queries  # noqa: E402
from tidewater.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.1")
    spark = build_session()
    for key in sys.argv[1:]:
        print(f"===== {key}")
        queries()[key](spark, sf).explain(os.environ.get("MODE", "simple"))
    spark.stop()
