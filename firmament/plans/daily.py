"""The daily review run: collect, merge, list what is missing."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from firmament.plans.review import collect_reviews, merge_master, missing_tasks, owners_of_groups
from firmament.sources.sinks import overwrite


def run_reviews(spark: SparkSession, reviewed: dict[str, tuple[str, DataFrame]], paths: dict[str, str], extra: DataFrame | None = None,
                extracted: DataFrame | None = None, groups: DataFrame | None = None, prefer_order: list[str] | None = None,
                required: list[str] | None = None) -> DataFrame:
    """Collect reviewers' tables, merge them into the master and list its blank cells; returns rows per table.

    ``paths`` names the tables ``manual``, ``master`` and ``missing``. Each is written once, whole, and the next step reads
    what was written: the merge runs once for the master and its tasks alike. A step that fails leaves the tables of the
    steps behind it as they were; the run can be begun again from the start.
    """
    overwrite(collect_reviews(reviewed, prefer_order), paths["manual"])
    overwrite(merge_master(spark.read.parquet(paths["manual"]), extra, extracted), paths["master"])
    owners = None if groups is None else owners_of_groups(groups)
    overwrite(missing_tasks(spark.read.parquet(paths["master"]), required, owners), paths["missing"])
    out = None
    for name in ("manual", "master", "missing"):
        one = spark.read.parquet(paths[name]).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
