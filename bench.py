"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tagloom.plans import catalog

#: Cheap ones first: what no longer fits into BENCH_SECONDS is reported as null, never left out silently.
HEADLINE = [
    "b1_tokenize", "b2_align_offsets", "c5_casing", "d4_next2", "e2_exact_lexicon", "h1_bio_decode", "b3_bio_tag",
    "d1_previous", "i2_statistics", "e4_embedding_bins", "b2_align_offsets_treebank", "e6_assemble", "e1_fuzzy_lexicon",
    "i7_error_analysis", "f4_fit_naive_bayes", "j1_extract_features", "j3_score_stream", "f5_predict_naive_bayes",
    "j2_train_and_score", "g5_decode_crf", "g4_crf_gradient", "g4_fit_crf", "i6_ablation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "20g"))
        .config("spark.sql.shuffle.partitions", str(4 * int(cpus)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    catalog.QUERIES["b1_tokenize"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    began, most = time.time(), float(os.environ.get("BENCH_SECONDS", "600"))
    for name in os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split():
        if time.time() - began > most:
            times[name] = None
            continue
        start = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(t for t in times.values() if t), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
