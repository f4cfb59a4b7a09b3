"""Configuration of watched folders and the notification table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.totals import join_rows

# Environment to the column that holds its folder.
LOCATION_COLUMNS = {"DEV": "filelocationdev", "QA": "filelocationqa", "PROD": "filelocation"}


def location_column(env: str) -> str:
    """Folder column of an environment; an unknown environment is an error."""
    try:
        return LOCATION_COLUMNS[env.upper()]
    except KeyError:
        raise ValueError(f"unknown environment {env!r}, expected one of {sorted(LOCATION_COLUMNS)}") from None


def active_watch_config(config: DataFrame, env: str) -> DataFrame:
    """Active entries that start an evaluation, with the folder of the environment."""
    rows = config.where(F.col("active") & F.col("trigger_eval_engine"))
    return rows.select("pmd_client_id", "filetype", "filename",
                       F.col(location_column(env)).alias("filelocation"))


# Column heads of the notification table and the columns below them.
REPORT_COLUMNS = {
    "PMD Client ID": "pmd_client_id",
    "File Type": "filetype",
    "File Pattern": "filename",
    "File Location": "filelocation",
    "Last Date Received": "lastdatereceived",
    "Unprocessed Filecount": "unprocessed_filecount",
}


def html_report(config: DataFrame) -> DataFrame:
    """One row with an HTML table of the active entries that have files waiting.

    The configuration table has one row per client and file type, so the text
    stays small. Rows are ordered by client, type and pattern.
    """
    waiting = config.where(F.col("active") & (F.col("unprocessed_filecount") > 0))
    cells = [F.concat(F.lit("<td>"), F.col(c).cast("string"), F.lit("</td>")) for c in REPORT_COLUMNS.values()]
    rows = join_rows(waiting, F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")), "",
                     ["pmd_client_id", "filetype", "filename"], "rows")
    heads = "".join(f"<th>{head}</th>" for head in REPORT_COLUMNS)
    title = "<h3>File Watcher notification</h3>"
    return rows.select(F.concat(
        F.lit(f"<html><body>{title}<table border=1><tr>{heads}</tr>"),
        F.coalesce("rows", F.lit("")), F.lit("</table></body></html>")).alias("report"))
