"""Ingest a folder of documents and publish its text and its chunks.

spark-submit jobs/run_documents.py --configs FOLDER [--checkpoint FOLDER] [--prefix SCHEMA.]
spark-submit jobs/run_documents.py --configs FOLDER --follow FOLDER

With --follow the layers are kept in that folder, and a run takes over what came, changed and went.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from layerworks.config import load_parsing_config
from layerworks.plans.arrivals import DocumentCollection
from layerworks.plans.datasets import publish_all
from layerworks.plans.documents import document_datasets


def run(spark: SparkSession, configs: str, checkpoint: str | None = None, prefix: str = "") -> None:
    """Publish the layers, and show some chunks and some of the quarantine."""
    datasets = document_datasets(load_parsing_config(spark, configs), checkpoint, prefix=prefix)
    for name, counts in publish_all(spark, datasets).items():
        print(name, counts)
    _, _, quarantine, _, gold = (spark.table(dataset.name) for dataset in datasets)
    gold.select("document_id", "chunk_index", "chunk_text").orderBy("document_id", "chunk_index").show()
    quarantine.show()


def follow(spark: SparkSession, configs: str, folder: str) -> None:
    """Bring the layers of a folder up to date, and show some chunks and some of the quarantine."""
    collection = DocumentCollection(folder, load_parsing_config(spark, configs))
    print("files", collection.refresh(spark))
    gold = collection.gold(spark)
    gold.select("document_id", "chunk_index", "chunk_text").orderBy("document_id", "chunk_index").show()
    collection.quarantine(spark).show()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--configs", required=True, help="folder of parsing.yaml")
    parser.add_argument("--checkpoint", help="folder for the stream's progress, in incremental mode")
    parser.add_argument("--prefix", default="", help="put before every table name")
    parser.add_argument("--follow", help="folder to keep the layers in, brought up to date by each run")
    options = parser.parse_args()
    if options.follow:
        follow(SparkSession.builder.getOrCreate(), options.configs, options.follow)
        return
    run(SparkSession.builder.getOrCreate(), options.configs, options.checkpoint, options.prefix)


if __name__ == "__main__":
    main()
