"""``python -m tidemark <view> --data DIR``: shows a view over stored tables, or a registered query over ``--data``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark.operators import views
from tidemark.plans import catalogue


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("view", help="active, priority, all, summary, street, or a query of the catalogue")
    p.add_argument("--data", required=True, help="folder of parquet tables")
    p.add_argument("--street", default="", help="what to look for, for the view street")
    p.add_argument("--removed", action="store_true", help="include removed rows")
    p.add_argument("--type", default=None)
    p.add_argument("--deal", default=None)
    p.add_argument("--rows", type=int, default=20)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.view in catalogue.QUERIES:
        out = catalogue.QUERIES[a.view](spark, a.data)
    else:
        view = views.with_latest(spark.read.parquet(f"{a.data}/listings"), spark.read.parquet(f"{a.data}/observations"))
        out = views.on_street(view, a.street, a.removed, a.type, a.deal) if a.view == "street" else views.exported(view)[a.view]
    out.show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
