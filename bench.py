"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs
``BENCH_RUNS`` times (default 3) to a sink that keeps nothing, and the median
counts. Training runs once, afresh; the queries after it use what it learnt.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame

from checks import queries
from checks.compare import session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

ONCE = ["bpe_train", "bpe_train_byte"]
# Large trainings: timed, but not part of the total, which stays comparable; the queries after them use what they learnt.
LARGE = ["bpe_train_2000", "bpe_train_byte_2000"]
REPEATED = [
    "split_counts",
    "split_exact",
    "sample_capped",
    "filter_length",
    "word_counts_char",
    "word_counts_byte",
    "bpe_pair_counts",
    "encode",
    "encode_byte",
    "decode",
    "round_trip",
    "model_sequences",
    "batches_padded",
    "token_budget",
    "tokenizer_eval",
    "model_ready",
    "softmax_scores",
    "topp_candidates",
    "seeded_draw",
    "cross_entropy",
    "epoch_losses",
    "running_loss",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session(CPUS)
    run(queries.word_counts_char(spark, SF_DIR))
    seconds = {}
    for name in ONCE + LARGE + REPEATED:
        query = queries.all_queries()[name]
        taken = []
        for _ in range(RUNS if name in REPEATED else 1):
            start = time.perf_counter()
            run(query(spark, SF_DIR))
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds[name] for name in ONCE + REPEATED), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
        "cpus": int(CPUS),
        "documents": queries.documents(spark, SF_DIR).count(),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
