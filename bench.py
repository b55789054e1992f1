"""Timings of the headline work; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data
and cores. Each figure is the median of three warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ferryline.checks import CHECKS  # noqa: E402
from ferryline.operators.load import load  # noqa: E402
from ferryline.runtime import local_session, shared_folder  # noqa: E402
from ferryline.sources.feed_format import FeedFormat, LOAD_FORMAT  # noqa: E402
from ferryline.sources.feed_reader import read_feed  # noqa: E402
from ferryline.sources.feed_writer import write_feed  # noqa: E402

RUNS = 3

REGISTERED = [
    "order_range",
    "order_summary",
    "inner_join_cond",
    "bucketed_join",
    "ordered_string_agg",
    "key_scan",
    "key_scan_estimate",
    "worst_skew",
    "skew_summary",
    "table_skew_topk",
    "rows_to_move",
    "delete_batches",
    "inventory_summary",
    "transfer_skips",
    "run_readiness",
    "phase_breakdown",
    "load_good",
    "stream_ingest",
    "display_width",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    timings: dict[str, float] = {}
    rates: dict[str, float] = {}

    def measure(name: str, run) -> float:
        run()
        seconds = []
        for _ in range(RUNS):
            started = time.perf_counter()
            run()
            seconds.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(seconds), 3)
        return timings[name]

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    counts = {"lineitem": lines.count(), "documents": documents.count()}
    folders: dict[str, str] = {}

    def export(name: str, df, fmt: FeedFormat, **options) -> None:
        folders[name] = shared_folder(spark, "bench")
        write_feed(df, folders[name], fmt, **options)

    for table, df in (("lineitem", lines), ("documents", documents)):
        for label, fmt, options in (
            ("plain", FeedFormat(), {"files": 8}),
            ("gzip", LOAD_FORMAT, {"gzip": True, "files": 8}),
        ):
            name = f"write_feed_{table}_{label}"
            seconds = measure(name, lambda: export(name, df, fmt, **options))
            rates[name] = round(counts[table] / seconds)
            source, name = folders[name], f"read_feed_{table}_{label}"
            seconds = measure(name, lambda: drain(read_feed(spark, source, df.schema, fmt)))
            rates[name] = round(counts[table] / seconds)
    source = folders["write_feed_lineitem_plain"]
    flagged = "read_feed_lineitem_flagged"
    seconds = measure(flagged, lambda: drain(read_feed(spark, source, lines.schema, on_error="flag")))
    rates[flagged] = round(counts["lineitem"] / seconds)
    seconds = measure(
        "load_lineitem", lambda: load(read_feed(spark, source, lines.schema), shared_folder(spark, "bench"))
    )
    rates["load_lineitem"] = round(counts["lineitem"] / seconds)

    for name in REGISTERED:
        measure(name, lambda: drain(CHECKS[name].run(spark, sf)))

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, median of three warm runs",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "rows_per_second": rates,
                "sf": sf.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
