"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from checks.session import local_session

HEADLINE = [
    "page_identity", "site_identity", "site_eligibility", "site_name_disambiguation",
    "new_articles", "split_batches", "trigram_similarity", "trigram_similarity_join",
    "normalize_text", "tokens_no_stopwords", "date_mentions", "quiet_hours",
    "tag_histogram", "text_blocks", "extract_title", "extract_author", "extract_date",
    "extract_content", "harvest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.read.parquet(f"{folder}/nation.parquet").count()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
