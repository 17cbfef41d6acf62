"""Command line: `python -m corpusmill.plans.cli filter|mix|tokenize --config FILE --input DIR --output DIR`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..operators import tokenizing
from ..sources import config
from .runs import run_filter, run_mix, run_tokenize


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("what", choices=("filter", "mix", "tokenize"))
    for name in ("config", "input", "output"):
        parser.add_argument(f"--{name}", required=True)
    for name in ("start-file", "limit-files", "limit-rows"):
        parser.add_argument(f"--{name}", type=int)
    parser.add_argument("--run-id")
    parser.add_argument("--pattern", help="names of the files to tokenize, instead of the shards that a mix lists")
    parser.add_argument("--tokenizer", help="a `tokenizers` JSON file")
    parser.add_argument("--eos", default="<|endoftext|>")
    parser.add_argument("--dry-run", action="store_true")
    parser.add_argument("--no-resume", action="store_true")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("corpusmill").getOrCreate()
    data = config.load(a.config)
    if a.what == "filter":
        run_filter(spark, data, a.input, a.output, a.start_file or 0, a.limit_files, a.limit_rows, a.run_id, a.dry_run, not a.no_resume).show(1000, False)
    elif a.what == "mix":
        run_mix(spark, data, a.input, a.output, a.dry_run, not a.no_resume).show(1000, False)
    else:
        print(run_tokenize(spark, data, a.input, a.output, tokenizing.FileTokenizer(a.tokenizer, a.eos), a.pattern, a.dry_run, not a.no_resume))


if __name__ == "__main__":
    main()
