"""Commands of the library, for ``spark-submit`` or ``python -m claimloom``.

combine:    --input IN --output OUT --format parquet
translate:  translate --input RAW --lookups LISTS --output OUT --format parquet
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from claimloom.plans.combine import combine_to_files
from claimloom.plans.translate import translate_to_files
from claimloom.sources.readers import FORMATS


def main(argv: list[str] | None = None) -> list[str]:
    argv = list(sys.argv[1:] if argv is None else argv)
    command = argv.pop(0) if argv and argv[0] in ("combine", "translate") else "combine"
    about = {"combine": "Combine subsamples into the nine tables.", "translate": "Translate raw feeds into subsamples."}
    parser = argparse.ArgumentParser(prog=f"claimloom {command}", description=about[command])
    parser.add_argument("--input", required=True, help="folder with <table>_<n>.<format> files")
    parser.add_argument("--output", required=True, help="folder for the tables")
    parser.add_argument("--format", required=True, choices=FORMATS, help="output format")
    parser.add_argument("--input-format", default="parquet", choices=FORMATS)
    parser.add_argument("--first", type=int, help="first subsample (default: lowest found)")
    parser.add_argument("--last", type=int, help="last subsample (default: highest found)")
    if command == "translate":
        parser.add_argument("--lookups", required=True, help="folder with the code lists and the area table")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("claimloom").getOrCreate()
    span = {"first": args.first, "last": args.last, "fmt": args.input_format}
    if command == "translate":
        written = translate_to_files(spark, args.input, args.lookups, args.output, args.format, **span)
        return [p for paths in written.values() for p in paths]
    return combine_to_files(spark, args.input, args.output, args.format, **span)


if __name__ == "__main__":
    main()
