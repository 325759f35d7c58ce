"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores. Each query
runs once untimed, for the JVM to compile it, and once timed.
"""

import json
import os
import re
import time

from pyspark.sql import SparkSession

from broadsheet.catalog import QUERIES

HEADLINE = (
    "article_index", "parse_articles", "corpus_stats", "stem_vocabulary", "text_to_terms",
    "term_frequency", "dph_query_score", "rank_by_score", "top10_plain", "top10_diverse",
    "document_rankings",
)


def seconds(query, spark, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("broadsheet-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_CHECKPOINT_DIR", "spark-warehouse/checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(QUERIES[name], spark, sf_dir)
        times[name] = seconds(QUERIES[name], spark, sf_dir)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "seconds for the whole ranking job (document_rankings)",
        "value": times["document_rankings"],
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
