"""The ingestion summary report.

All numbers come from one Spark aggregate pass (A1-A6 as grouping sets) whose result is bounded by the
number of months, pollutants and stations; only that small result reaches the driver to be formatted.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from aerolake.session import local_path

# The report's title and line labels, in report order (they must read exactly like this).
RULE = "=" * 60
TITLE = "INGESTION SUMMARY"
LABELS = {
    "total_records": "Total records      : ",
    "n_columns": "Columns            : ",
    "date_range": "Date range         : ",
    "years": "Years              : ",
    "stations": "Stations           : ",
    "pollutant_species": "Pollutant species  : ",
    "per_month": "Records per year-month:",
    "per_pollutant": "Records per pollutant:",
}


def _fmt_int(n: int) -> str:
    return f"{n:,}"


def format_summary(summary: dict, per_month: list[tuple[int, int, int]],
                   per_pollutant: list[tuple[str, int]]) -> str:
    """Render the report text from already-aggregated results. The two tables follow the usual layout of a
    printed count series: key columns padded to the wider of name and values, the year shown once per
    block, counts right-aligned after four spaces."""
    lines = [RULE, TITLE, RULE,
             LABELS["total_records"] + _fmt_int(summary["total_records"]),
             LABELS["n_columns"] + str(summary["n_columns"]),
             LABELS["date_range"] + f"{summary['date_min']}  ->  {summary['date_max']}",
             LABELS["years"] + str(summary["years"]),
             LABELS["stations"] + str(summary["stations"]),
             LABELS["pollutant_species"] + str(summary["pollutant_species"]),
             "", LABELS["per_month"]]
    yw = max([len("year")] + [len(str(y)) for y, _, _ in per_month])
    mw = max([len("month")] + [len(str(m)) for _, m, _ in per_month])
    cw = max([1] + [len(str(c)) for _, _, c in per_month])
    lines.append(f"{'year':<{yw}}  {'month':<{mw}}")
    prev = None
    for y, m, c in per_month:
        ylab = str(y) if y != prev else ""
        prev = y
        lines.append(f"{ylab:<{yw}}  {str(m):<{mw}}    {c:>{cw}}")
    lines += ["", LABELS["per_pollutant"], "pollutant"]
    nw = max([len("pollutant")] + [len(str(p)) for p, _ in per_pollutant])
    pw = max([1] + [len(str(c)) for _, c in per_pollutant])
    for p, c in per_pollutant:
        lines.append(f"{str(p):<{nw}}    {c:>{pw}}")
    return "\n".join(lines)


# One scan for the whole report: each grouping set yields dimension-sized groups (months, pollutants,
# stations) with their row count and datetime range; partial aggregation runs before the shuffle.
PROFILE_SQL = """
SELECT grouping_id(year, month, pollutant, station_id) AS gid, year, month, pollutant, station_id,
       count(*) AS n, min(datetime) AS dmin, max(datetime) AS dmax
FROM {df}
GROUP BY GROUPING SETS ((year, month), (pollutant), (station_id))
"""


def ingestion_profile(df: DataFrame) -> dict:
    """All numbers of the report from one pass over ``df``: totals, datetime range, sorted years, distinct
    stations / pollutants (NULL excluded), rows per year-month (NULL keys dropped), rows per pollutant."""
    rows = df.sparkSession.sql(PROFILE_SQL, df=df).collect()  # bounded: months + pollutants + stations
    gid_month = 0b0011  # grouped by year, month
    gid_pollutant = 0b1101
    gid_station = 0b1110
    months = sorted((r["year"], r["month"], r["n"]) for r in rows
                    if r["gid"] == gid_month and r["year"] is not None and r["month"] is not None)
    pollutants = [r for r in rows if r["gid"] == gid_pollutant]
    stations = [r for r in rows if r["gid"] == gid_station]
    per_pollutant = sorted(((r["pollutant"], r["n"]) for r in pollutants if r["pollutant"] is not None),
                           key=lambda t: (-t[1], t[0]))
    dmins = [r["dmin"] for r in pollutants if r["dmin"] is not None]
    dmaxs = [r["dmax"] for r in pollutants if r["dmax"] is not None]
    years = sorted({y for y, _, _ in months} | {r["year"] for r in rows if r["gid"] == gid_month and r["year"] is not None})
    summary = {
        "total_records": sum(r["n"] for r in pollutants),
        "n_columns": len(df.columns),
        "date_min": min(dmins) if dmins else None,
        "date_max": max(dmaxs) if dmaxs else None,
        "years": "[" + ", ".join(str(y) for y in years) + "]",
        "stations": sum(1 for r in stations if r["station_id"] is not None),
        "pollutant_species": sum(1 for r in pollutants if r["pollutant"] is not None),
    }
    return {"summary": summary, "per_month": months, "per_pollutant": per_pollutant}


def generate_summary(df: DataFrame, output_path: str) -> str:
    """Compute the summary with Spark (one scan), write it as UTF-8 text to ``output_path``, return it."""
    prof = ingestion_profile(df)
    text = format_summary(prof["summary"], prof["per_month"], prof["per_pollutant"])
    scheme = output_path.split("://", 1)[0] if "://" in output_path else "file"
    try:
        if scheme == "file":
            path = local_path(output_path)
            os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
            with open(path, "w", encoding="utf-8") as fh:
                fh.write(text)
        else:
            # shared storage (hdfs://, s3a://, ...): a one-row text dataset, never the driver's local disk
            (df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1)
               .write.mode("overwrite").text(output_path))
    except Exception as err:
        raise IOError(f"Failed to write summary report: {err}") from err
    return text
