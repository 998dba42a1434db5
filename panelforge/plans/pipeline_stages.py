"""Stage compositions of the batch flow: clean every dataset of a stage
directory (with a run summary), merge the final panel, and cut the analysis
blocks out of the sparse union."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.coerce import to_date_lenient, to_double
from panelforge.operators import clean, reshape
from panelforge.session import ensure_checkpoint_dir
from panelforge.sources.files import list_datasets, read_lenient_csv
from panelforge.sources.sinks import write_run_summary, write_table


def clean_stage(spark: SparkSession, in_dir: str, out_dir: str, exclude: Iterable[str] = (),
                fmt: str = "parquet") -> DataFrame:
    """Clean every CSV of ``in_dir`` by its dataset rules, write
    ``<out_dir>/<stem>_cleaned`` per dataset and ``<out_dir>/cleaning_summary``
    (one audit row per dataset).  The funnel counts are observed on the
    flagged rows during the write of the cleaned rows (``Observation``), so
    each dataset is cleaned and counted in the same job.  The observation
    sits in the final (result) stage, whose metric updates Spark applies once
    per partition, so task retries after an executor loss do not double count."""
    from pyspark.sql import Observation
    rows = []
    for path in list_datasets(spark, in_dir, ".csv", exclude):
        name = path.rsplit("/", 1)[-1]
        stem = name[: -len(".csv")]
        df = read_lenient_csv(spark, path)  # a file, or a folder of part files
        flagged, rule = clean.clean_flags(df, name)
        obs = Observation(f"funnel_{stem}")
        observed = flagged.observe(obs, F.count(F.lit(1)).alias("rows_in"),
                                   F.count_if(F.col("_req")).alias("rows_after_required"),
                                   F.count_if(F.col("_keep")).alias("rows_after_outliers"))
        write_table(observed.where(F.col("_keep")).drop("_req", "_keep"), f"{out_dir}/{stem}_cleaned", fmt=fmt)
        m = obs.get
        rows.append((name, f"{stem}_cleaned", m["rows_in"], m["rows_after_required"], m["rows_after_outliers"],
                     m["rows_in"] - m["rows_after_required"], m["rows_after_required"] - m["rows_after_outliers"],
                     list(rule.required), list(rule.outliers), list(rule.groups)))
    audits = spark.createDataFrame(rows, clean.AUDIT_SCHEMA)
    if rows:
        write_run_summary(audits, f"{out_dir}/cleaning_summary")
    return audits


def final_panel(df: DataFrame) -> tuple[DataFrame, dict]:
    """Drop all-null rows, drop all-null columns, remove exact duplicates and
    order by every column (nulls last).  Returns (panel, counts) where counts
    has rows_in, dropped_all_null_rows, empty_columns, duplicates_removed,
    rows_out.

    ``df`` is read twice: one aggregation counts rows and the non-null values of all columns, then the
    deduplicated rows are frozen, so that their count and every later use come from that one shuffle."""
    ensure_checkpoint_dir(df.sparkSession)
    cols = df.columns
    filled = [F.col(f"`{c}`").isNotNull() & (~F.isnan(f"`{c}`") if df.schema[c].dataType.typeName() in ("double", "float") else F.lit(True)) for c in cols]
    some = F.lit(False)
    for x in filled:
        some = some | x
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(some).alias("kept"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    empty = [c for i, c in enumerate(cols) if seen[f"c{i}"] == 0]
    panel = clean.drop_all_null_rows(df).drop(*empty)
    deduped = panel.dropDuplicates().checkpoint(eager=True)
    out = deduped.count()
    meta = {"rows_in": seen["rows"], "dropped_all_null_rows": seen["rows"] - seen["kept"], "empty_columns": empty,
            "duplicates_removed": seen["kept"] - out, "rows_out": out}
    return reshape.sort_all_nulls_last(deduped), meta


def panel_audit(spark: SparkSession, meta: dict) -> DataFrame:
    """The counts of :func:`final_panel` as one row."""
    row = (meta["rows_in"], meta["dropped_all_null_rows"], ", ".join(meta["empty_columns"]), meta["duplicates_removed"], meta["rows_out"])
    return spark.createDataFrame([row], "rows_in bigint, dropped_all_null_rows bigint, empty_columns string, duplicates_removed bigint, rows_out bigint")


# The two analysis blocks of the union table.
MACRO_COLUMNS = ("date", "cpi_all_items", "policy_rate", "industrial_production")
ENERGY_COLUMNS = ("time_period", "ref_area", "flow_breakdown", "obs_value", "unit_measure")


def analysis_blocks(union: DataFrame, macro_cols=MACRO_COLUMNS, energy_cols=ENERGY_COLUMNS,
                    macro_date: str = "date", energy_time: str = "time_period") -> tuple[DataFrame, DataFrame]:
    """(macro, energy) blocks of the sparse union: the macro block keeps rows
    complete on its columns, with the date parsed; the energy block keeps rows
    with period, area and value, value coerced to a number and period parsed."""
    macro = clean.complete_cases(union, list(macro_cols))
    macro = macro.withColumn(macro_date, to_date_lenient(macro_date)).where(F.col(macro_date).isNotNull())
    energy = clean.require_fields(union.select(*energy_cols), [energy_time, "ref_area", "obs_value"])
    energy = energy.withColumns({"time": to_date_lenient(energy_time), "obs_value": to_double("obs_value")})
    energy = energy.where(F.col("time").isNotNull() & F.col("obs_value").isNotNull())
    return macro, energy
