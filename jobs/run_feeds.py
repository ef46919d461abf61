"""Ingest clients' feeds and publish their common model.

spark-submit jobs/run_feeds.py --configs FOLDER --clients company_a company_b [--prefix SCHEMA.]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from layerworks.config import load_client_config
from layerworks.operators.quality import ingest_metrics
from layerworks.operators.summaries import count_by
from layerworks.plans.datasets import publish_all
from layerworks.plans.feeds import feed_datasets


def run(spark: SparkSession, configs: str, clients: Sequence[str], prefix: str = "") -> None:
    """Publish Bronze and Silver of every client and their union, and show what came of it."""
    loaded = [load_client_config(spark, configs, client) for client in clients]
    datasets = feed_datasets(loaded, prefix=prefix)
    for name, counts in publish_all(spark, datasets).items():
        print(name, counts)
    for client in clients:
        ingest_metrics(spark.table(f"{prefix}bronze_{client}")).show()
    count_by(spark.table(datasets[-1].name), "source_client", "department").show()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--configs", required=True, help="folder of <client>.yaml")
    parser.add_argument("--clients", required=True, nargs="+")
    parser.add_argument("--prefix", default="", help="put before every table name")
    options = parser.parse_args()
    run(SparkSession.builder.getOrCreate(), options.configs, options.clients, options.prefix)


if __name__ == "__main__":
    main()
