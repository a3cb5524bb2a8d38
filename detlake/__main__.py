"""``python -m detlake [QUERY FOLDER [OUTPUT]]``: list the registered queries, or run one over a folder of tables; ``python -m detlake COMMAND OUT IN...``: run a job."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from . import commands
from .plans.queries import QUERIES


def main(args: list[str]) -> int:
    if args and args[0] in commands.COMMANDS:
        return commands.main(args)
    if len(args) < 2:
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = SparkSession.builder.appName(f"detlake {args[0]}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    df = QUERIES[args[0]](spark, args[1])
    if len(args) > 2:
        df.write.mode("overwrite").parquet(args[2])
    else:
        df.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
