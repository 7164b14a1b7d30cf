"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of tables, /root/testdata/sf0.1 by default
    BENCH_CPUS     local cores, 8 by default
    BENCH_QUERIES  names separated by commas, the headline ones by default
    BENCH_RUNS     runs of each query, 2 by default; the fastest counts, since the
                   first one also compiles its code
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import all_queries, line_files  # noqa: E402
from corpusloom.plans.word_count import split_sweep  # noqa: E402
from corpusloom.session import get_session  # noqa: E402

HEADLINE = [
    "word_count",
    "word_count_files",
    "metadata",
    "books_per_year",
    "books_per_language",
    "title_statistics",
    "authors",
    "author_variants",
    "out_degree_x5",
    "in_degree_x5",
    "top_influential_x5",
    "window_sweep",
    "clean_text",
    "filtered_tokens",
    "term_frequency",
    "term_idf",
    "similar_exact_top5",
    "similar_hashed_top5",
    "similar_hashed_all",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    named = os.environ.get("BENCH_QUERIES")
    names = named.split(",") if named else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {
        name: min(_run(queries[name], spark, folder) for _ in range(runs)) for name in names
    }
    sweep = [row.asDict() for row in split_sweep(spark, line_files(spark, folder)).collect()]
    found = re.search(r"sf([0-9.]+)$", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "split_sweep": sweep,
                "sf": float(found.group(1)) if found else folder,
            }
        )
    )


def _run(query, spark, folder: str) -> float:
    begin = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


if __name__ == "__main__":
    main()
