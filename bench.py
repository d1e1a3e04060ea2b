"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, "all" for every registered query). Each
query first runs once on the sf0.001 tables next to the folder, to warm up the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from revloom import build_session  # noqa: E402
from revloom.plans import catalog  # noqa: E402

HEADLINE = [
    "revision_scan",
    "prev_revision",
    "time_gaps",
    "moving_avg_gap",
    "link_extract",
    "markup_to_text",
    "segments",
    "tokens",
    "ngrams",
    "revision_diff",
    "diff_text",
    "diff_summary",
    "processed_revisions",
    "label_policies",
    "vocabulary",
    "tf_fixed_vocab",
    "tf_train_vocab",
    "scaled_tf",
    "nb_model",
    "nb_incremental",
    "nb_predict",
    "metrics",
    "reverted_from_diff",
    "nb_scaled",
    "incremental_stream",
    "ordered_diff",
    "scaled_tf_on_train",
    "linear_predict",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = build_session(
        "revloom-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(2 * int(cpus)),
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    def run(name, folder):
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    small = str(Path(sf).parent / "sf0.001")
    for name in names:  # compile the JVM's hot code on the smallest tables
        run(name, small if Path(small).is_dir() else sf)
    seconds = {}
    for name in names:
        seconds[name] = run(name, sf)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
