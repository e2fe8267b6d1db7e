"""A whole feed run: read, transform, write every output, report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..layouts import FEEDS, STRICT_FEEDS, Feed, with_row_length
from ..layouts import reports
from ..operators import audit
from ..operators.exceptions import exception_rows
from ..operators.lookups import checked_lookup
from ..layouts.model import UNRECOGNIZED
from ..operators.route import accepted
from ..operators.rules import ACCEPTED
from ..session import drop_folder, scratch_folder, tune
from ..sinks import writers
from ..sources import tables
from ..sources.lines import ORIGIN, read_lines, readable
from .transform import transform, verdicts

FILE_TYPES = {"position_balance": reports.POSITION_BALANCE_TYPES,
              "memo_position": reports.MEMO_POSITION_TYPES}


@dataclass
class Inputs:
    """Tables a run needs besides its lines; what is left out takes the built-in tables."""

    lookups: dict[str, DataFrame] = field(default_factory=dict)
    file_metadata: DataFrame | None = None
    exception_metadata: DataFrame | None = None
    report_template: DataFrame | None = None

    def filled(self, spark: SparkSession, feed: Feed) -> Inputs:
        return Inputs(self.lookups,
                      self.file_metadata or default_file_metadata(spark, feed),
                      self.exception_metadata or default_exception_metadata(spark),
                      self.report_template or default_report_template(spark))


def default_file_metadata(spark: SparkSession, feed: Feed) -> DataFrame:
    if feed.name in FILE_TYPES:
        return tables.pipe_text(spark, FILE_TYPES[feed.name], tables.FILE_METADATA)
    return audit.layout_metadata(spark, feed)


def default_exception_metadata(spark: SparkSession) -> DataFrame:
    return tables.pipe_text(spark, reports.EXCEPTION_TYPES, tables.EXCEPTION_METADATA)


def default_report_template(spark: SparkSession) -> DataFrame:
    return tables.pipe_text(spark, reports.REPORT_TEMPLATE, tables.REPORT_TEMPLATE)


def report_of(counted: DataFrame, inputs: Inputs, file_name: str, complete: bool = False) -> DataFrame:
    """Report lines with their values, for ``long_report`` and ``tabular_report``, from a tally."""
    values = audit.audit_values(counted, inputs.file_metadata, inputs.exception_metadata, complete)
    return audit.filled_report(values, inputs.report_template, inputs.file_metadata, file_name)


def audit_report(rows: DataFrame, inputs: Inputs, file_name: str, complete: bool = False) -> DataFrame:
    return report_of(audit.tally(rows), inputs, file_name, complete)


def _split_verdicts(rows: DataFrame, feed: Feed, folder: str) -> tuple[DataFrame, list[tuple]]:
    """One pass: what is not accepted is stored in ``folder``; accepted and missing lines are counted.

    The counts are observed while the rows are written: accepted lines are neither kept nor shuffled.
    """
    seen = Observation("verdicts")
    ok = ~F.col("_MISSING") & (F.col("_ROW_STATUS") == ACCEPTED)
    types = [t.name for t in feed.types] + [UNRECOGNIZED]
    observed = rows.observe(seen, F.count_if("_MISSING").alias("missing"), *(
        F.count_if(ok & (F.col("_ROW_TYPE") == name)).alias(f"t{i}") for i, name in enumerate(types)))
    observed.where(~ok).write.parquet(folder)
    counts = seen.get
    return rows.sparkSession.read.schema(rows.schema).parquet(folder), [
        (name, ACCEPTED, [], counts[f"t{i}"]) for i, name in enumerate(types) if counts[f"t{i}"]] + [
        (None, None, [], counts["missing"])] * bool(counts["missing"])


def run_feed(spark: SparkSession, feed: Feed | str, source: str | list[str] | DataFrame, out: str, *,
             inputs: Inputs | None = None, file_name: str | None = None, mode: str = "append",
             skip_empty: bool = False, diagnostic: bool = False, complete: bool = False,
             strict: bool = False, row_length: int | None = None, encoding: str | None = None) -> None:
    """Write ``target``, ``rejected``, ``exceptions``, ``audit`` and ``audit_tab`` below ``out``.

    The source is read twice: once for the verdicts, where rejected lines go to a scratch folder and
    all others are only counted, and once for the target. ``target`` has one folder per source file,
    in the order of its lines; a source that is a table has one folder in the order of ``_ROW_ID``,
    which must be a function of the row (an id column, or the place in a plain scan). Rejected lines
    and exceptions keep their blanks. Every line is accepted, rejected or missing (null), so rows in
    are the sum of the three. Of equal lookup keys one counts (see ``unique_lookup``). ``strict`` takes
    a named feed as published, with its overlapping fields; ``row_length`` takes lines of another length.
    ``encoding`` (``UTF-8``, ``ISO-8859-1``, ``US-ASCII``) decodes the lines of a text source: a line that is
    no text of it is quarantined with its bytes (hex), so rows in = target + rejected + quarantined still holds.
    """
    tune(spark)
    feed = (STRICT_FEEDS if strict else FEEDS)[feed] if isinstance(feed, str) else feed
    feed = with_row_length(feed, row_length) if row_length else feed
    inputs = (inputs or Inputs()).filled(spark, feed)
    table = isinstance(source, DataFrame)
    lines = source if table else read_lines(spark, source, origin=True, encoding=encoding)
    order = ("_ROW_ID",) if table else (*ORIGIN, "_ROW_ID")
    file_name = file_name or (source.rstrip("/").rsplit("/", 1)[-1] if isinstance(source, str) else feed.name)

    checks = {name: checked_lookup(tables.unique_lookup(df)) for name, df in inputs.lookups.items()}
    lookups = {name: df for name, (df, _) in checks.items()}
    moved = not all(small for _, small in checks.values())      # the join with a large lookup shuffles

    scratch = scratch_folder(spark, "rejected")
    try:
        bad, counts = _split_verdicts(
            verdicts(lines.withColumn("_MISSING", F.col("value").isNull()), feed, lookups), feed, scratch)
        refused = bad.where(~F.col("_MISSING"))
        n_bad, n_good = refused.count(), sum(n for _, status, _, n in counts if status == ACCEPTED)
        if n_bad or not skip_empty:
            writers.write_rejected(refused, f"{out}/rejected", mode, order)
            writers.write_exceptions(exception_rows(refused), f"{out}/exceptions", mode, order)
        if any(status is None for _, status, _, _ in counts):
            missing = bad.where("_MISSING").select("_ROW_ID", F.lit(None).cast("string").alias("value"),
                                                   *[c for c in ("_BYTES",) if c in bad.columns])
            writers.write_quarantine(missing, f"{out}/error", mode)

        counted = audit.tally(refused).unionByName(
            tables.local_table(spark, counts, audit.TALLY)) if counts else audit.tally(refused)
        filled = report_of(counted, inputs, file_name, complete)
        writers.write_report(audit.long_report(filled), f"{out}/audit", mode)
        writers.write_report(audit.tabular_report(filled), f"{out}/audit_tab", mode)

        good = accepted(transform(readable(lines), feed, lookups))
        if n_good or not skip_empty:
            if table:
                writers.write_target(good, f"{out}/target", mode, order)
            else:
                writers.write_target_by_file(good, f"{out}/target", lines.inputFiles(), mode, moved)
        if diagnostic:
            writers.write_diagnostic(good, f"{out}/target_with_row_id")
    finally:
        drop_folder(spark, scratch)
