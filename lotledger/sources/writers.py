"""Sinks: site table, feed export, run control, alerts, rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def append(df: DataFrame, path: str, site: str | None = None) -> None:
    """Append rows to the site table. `site` fills the partition column if the rows lack it."""
    if site is not None:
        df = df.withColumn("site", F.lit(site))
    df.write.mode("append").partitionBy("site").parquet(path)


def write_version(df: DataFrame, root: str, run_id: int, of: str | None = None) -> str:
    """Write a merged table beside its predecessor; readers move on when the run control says so.

    Run numbers count per site: under a root that sites share, `of` names the site.
    """
    path = f"{root}/{of}/run={run_id}" if of is not None else f"{root}/run={run_id}"
    df.write.mode("overwrite").partitionBy("site").parquet(path)
    return path


def _as_text(df: DataFrame) -> DataFrame:
    """Dates as `dd-MM-yyyy` and lists joined, as the feeds show them."""

    def shown(name: str, kind: str):
        if kind == "date":
            return F.date_format(name, "dd-MM-yyyy").alias(name)
        if kind == "array<string>":
            return F.array_join(name, ", ").alias(name)
        return F.col(name)

    return df.select(*[shown(f.name, f.dataType.simpleString()) for f in df.schema])


def export_json(df: DataFrame, path: str) -> None:
    _as_text(df).write.mode("overwrite").json(path)


def export_xml(df: DataFrame, path: str, row_tag: str = "item", root_tag: str = "items") -> None:
    writer = _as_text(df).write.mode("overwrite").format("xml")
    writer.option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def export(df: DataFrame, path: str, kind: str) -> None:
    {"json": export_json, "xml": export_xml}[kind](df, path)


def save_run(control: DataFrame, path: str) -> None:
    """Add the row that closes a run; `read_control` takes the latest per site."""
    control.coalesce(1).write.mode("append").parquet(path)


def write_alerts(df: DataFrame, path: str, query: str, batch_id: int) -> None:
    """The alerts of one batch of a query, in a folder of its own: a batch that is sent again replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/query={query}/batch={batch_id}")


def write_rejects(df: DataFrame, path: str) -> None:
    """Rejected rows, partitioned by their reason."""
    df.write.mode("append").partitionBy("reason").parquet(path)
