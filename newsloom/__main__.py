"""Run a job: ``spark-submit ... -m newsloom`` or ``python -m newsloom JOB --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from newsloom.lineage import clean
from newsloom.plans import jobs

_JOBS = {
    "keyword-frequency": (jobs.keyword_frequency, ["docs", "dictionary", "out"]),
    "keyword-partners": (jobs.keyword_partners, ["docs", "dictionary"]),
    "train": (jobs.train_classifier, ["training", "dictionary", "model-path"]),
    "classify": (jobs.classify_documents, ["docs", "dictionary", "model-path"]),
    "classify-first": (jobs.classify_first, ["docs", "dictionary", "model-path"]),
    "label-histogram": (jobs.classify_histogram, ["docs", "dictionary", "model-path"]),
    "synonyms": (jobs.word_synonyms, ["segmented", "word"]),
    "matrix-product": (jobs.matrix_product, ["left", "right"]),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="newsloom")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, (job, arguments) in _JOBS.items():
        command = commands.add_parser(name, help=job.__doc__)
        for argument in arguments:
            command.add_argument(f"--{argument}", required=True)
        command.add_argument("--write-to", help="write the rows as Parquet instead of showing them")
    given = vars(parser.parse_args(argv))
    job, arguments = _JOBS[given["job"]]
    is_own = SparkSession.getActiveSession() is None
    spark = SparkSession.builder.appName(f"newsloom {given['job']}").getOrCreate()
    result = job(spark, **{a.replace("-", "_"): given[a.replace("-", "_")] for a in arguments})
    if isinstance(result, DataFrame):
        if given["write_to"]:
            result.write.mode("errorifexists").parquet(given["write_to"])
        else:
            result.show(100, truncate=False)
    if is_own:
        clean(spark)


if __name__ == "__main__":
    main()
