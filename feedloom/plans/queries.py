"""The registered queries: every operator over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..layouts import CORRECTIONS, FEEDS, STRICT_FEEDS, Feed
from ..layouts.reports import RESULT_LABELS
from ..operators import audit
from ..operators.exceptions import exception_rows, split_failure_text
from ..operators.lookups import checked_lookup
from ..operators.positions import line_numbers
from ..operators.route import accepted, failure_text, rejected
from ..operators.split_types import sheet_table, split_cells
from ..session import scratch_folder, tune
from ..sinks import writers
from ..sources import files, tables
from ..sources.lines import read_lines, readable, table_lines, unreadable
from . import job
from .sample_lines import lines_sql
from .samples import LEDGER, ORDER_CODES, ORDER_LINES_SQL, ledger_lines_sql
from .transform import extract, outcomes, transform, typed

LEDGER_TYPES = ("ROW_TYPE_NO|ROW_TYPE|FIELDS_IN|FIELDS_OUT|TRANSFORMS\n"
                "1|ACCOUNT|9|10|2\n2|HOLDER|9|10|2\n3|BALANCE|9|10|2\n4|<Unrecognized>|0|0|0\n")
FILE_NAME = "SAMPLE"


def _sql(spark: SparkSession, sf_dir: str, text: str, *names_: str) -> DataFrame:
    """A query over sample tables, with the tables bound for this query only."""
    tune(spark)
    return spark.sql(text, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names_})


def _bound(text: str, table: str) -> str:
    return text.replace(f"FROM {table})", f"FROM {{{table}}})").replace(
        f"FROM {table}", f"FROM {{{table}}}")


def ledger_lines(spark, sf_dir, table="customer") -> DataFrame:
    return _sql(spark, sf_dir, _bound(ledger_lines_sql(table), table), table)


def ledger_rows(spark, sf_dir, table="customer") -> DataFrame:
    return transform(ledger_lines(spark, sf_dir, table), LEDGER)


def order_code_lines(spark, sf_dir) -> DataFrame:
    return _sql(spark, sf_dir, _bound(ORDER_LINES_SQL, "orders"), "orders")


def feed_lines(spark, sf_dir, feed: Feed, table="lineitem") -> DataFrame:
    return _sql(spark, sf_dir, _bound(lines_sql(feed, table), table), table)


def feed_rows(spark, sf_dir, feed: Feed) -> DataFrame:
    return transform(feed_lines(spark, sf_dir, feed), feed)


# --- scan, extract, classify ------------------------------------------------------------

def fw_extract(spark, sf_dir):
    return extract(ledger_lines(spark, sf_dir), LEDGER, "ACCOUNT").select(
        "_ROW_ID", F.col("CLIENT").alias("client"), F.col("KEY").alias("key"),
        F.col("NATION").alias("nation"), F.col("ACCOUNT TYPE").alias("account_type"),
        F.col("NEW ACCOUNT TYPE").alias("new_account_type"), F.col("NAME").alias("name"),
        F.col("CENTS").alias("cents"), F.col("SIGN").alias("sign"))


def fw_typed_structs(spark, sf_dir):
    rows = typed(ledger_lines(spark, sf_dir, "lineitem"), LEDGER)
    return rows.select("_ROW_ID", "_ROW_TYPE", F.col("ACCOUNT.CENTS").alias("account_cents"),
                       F.col("HOLDER.NAME").alias("holder_name"),
                       F.col("BALANCE.SIGN").alias("balance_sign"))


def fw_length_reject(spark, sf_dir):
    rows = rejected(ledger_rows(spark, sf_dir)).where("_ROW_STATUS IN (-1, -2)")
    return rows.select("_ROW_ID", "_ROW_TYPE", "_ROW_STATUS", F.length("_ROW_DATA").alias("width"))


def fw_classify(spark, sf_dir):
    return ledger_rows(spark, sf_dir, "orders").select("_ROW_ID", "_ROW_TYPE")


# --- translations --------------------------------------------------------------------------

def fw_xref_join(spark, sf_dir):
    rows = typed(ledger_lines(spark, sf_dir), LEDGER).where("_ROW_TYPE <> '<Unrecognized>'")
    return rows.select("_ROW_ID", F.col("_ROW_TYPE").alias("row_type"), F.coalesce(
        *(F.col(t.name)["ACCOUNT TYPE"] for t in LEDGER.types)).alias("account_type"))


def fw_xref_exchange_class(spark, sf_dir):
    feed = FEEDS["position_balance"]
    return extract(feed_lines(spark, sf_dir, feed), feed, "Customer Position Header").select(
        "_ROW_ID", F.col("EXCHANGE CODE").alias("exchange"), F.col("MSD CLASS CODE").alias("class"),
        F.col("ACCOUNT RANGE INDICATOR").alias("side"))


def fw_code_map(spark, sf_dir):
    return extract(order_code_lines(spark, sf_dir), ORDER_CODES, "ORDER", with_status=True).select(
        "_ROW_ID", "_ROW_STATUS", F.col("STATUS").alias("status"), F.col("ACTION").alias("action"),
        F.col("SPIN").alias("spin"), F.col("SWITCH").alias("switch"))


def fw_table_lookup(spark, sf_dir):
    """Lookup tables read from a pipe file and from a catalog view instead of the built-in ones."""
    tune(spark)
    folder = scratch_folder(spark, "lookup")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    writers.write_pipe_csv(nation.select(
        F.expr("substr('1234567890X', n_nationkey % 11 + 1, 1)").alias("_Key_AccType"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("_Value_AccType"))
        .orderBy(F.regexp_extract("_Value_AccType", "[0-9]+", 0).cast("int")).coalesce(1),
        folder, "overwrite")
    lookup, _ = checked_lookup(tables.read_lookup(spark, folder))
    rows = transform(ledger_lines(spark, sf_dir), LEDGER, {"account_type": lookup})
    return rows.select("_ROW_ID", "_ROW_STATUS", "_ROW_DATA")


# --- rules and routing ------------------------------------------------------------------------

def fw_filler_check(spark, sf_dir):
    failed = exception_rows(ledger_rows(spark, sf_dir))
    return failed.where("_EXCEPTION_TYPE = 'INVALID_FILLER'").select(
        "_ROW_ID", "_EXCEPTION_SOURCE", "_EXCEPTION_DESC")


def fw_status_last_wins(spark, sf_dir):
    return ledger_rows(spark, sf_dir).select("_ROW_ID", "_ROW_STATUS")


def fw_route_accepted(spark, sf_dir):
    return accepted(ledger_rows(spark, sf_dir, "lineitem")).select("_ROW_ID", "_ROW_TYPE")


def fw_route_rejected(spark, sf_dir):
    rows = rejected(ledger_rows(spark, sf_dir, "lineitem"))
    return rows.select("_ROW_ID", "_ROW_TYPE", "_ROW_STATUS", "_ROW_DATA")


def fw_render_pipe(spark, sf_dir):
    return accepted(ledger_rows(spark, sf_dir, "lineitem")).select("_ROW_ID", "_ROW_DATA")


def fw_exceptions(spark, sf_dir):
    return exception_rows(ledger_rows(spark, sf_dir))


def fw_failure_text(spark, sf_dir):
    rows = failure_text(rejected(ledger_rows(spark, sf_dir, "orders")))
    return rows.select("_ROW_ID", "_ROW_STATUS", "_ROW_EXCEPTIONS")


def fw_split_failure_text(spark, sf_dir):
    rows = failure_text(rejected(ledger_rows(spark, sf_dir, "orders")))
    return split_failure_text(rows.select("_ROW_ID", "_ROW_TYPE", F.explode(
        F.split("_ROW_EXCEPTIONS", ";")).alias("_ROW_EXCEPTION")))


# --- sinks, read back ---------------------------------------------------------------------------

def fw_roundtrip_sorted(spark, sf_dir):
    """Target in the order of the row ids, over many files; line numbers from the files alone."""
    folder = scratch_folder(spark, "target")
    rows = accepted(ledger_rows(spark, sf_dir, "orders"))
    writers.write_target(rows, folder, "overwrite", order=("_ROW_ID",))
    return line_numbers(read_lines(spark, folder, origin=True)).select(
        F.col("_LINE_NO").alias("line_no"), "value")


def fw_source_order(spark, sf_dir):
    """A source of many files: the target follows the files one after the other."""
    source, folder = scratch_folder(spark, "source"), scratch_folder(spark, "target")
    lines = ledger_lines(spark, sf_dir, "lineitem")
    lines.orderBy("_ROW_ID", "value").select("value").write.mode("overwrite").text(source)
    rows = transform(read_lines(spark, source, origin=True), LEDGER)
    writers.write_target(accepted(rows), folder, "overwrite", order=("_FILE", "_BLOCK", "_ROW_ID"))
    return line_numbers(read_lines(spark, folder, origin=True)).select(
        F.col("_LINE_NO").alias("line_no"), F.substring_index("value", "|", 2).alias("key"))


def sink_rejected(spark, sf_dir):
    folder = scratch_folder(spark, "rejected")
    writers.write_rejected(rejected(ledger_rows(spark, sf_dir, "orders")), folder, "overwrite")
    return spark.read.schema("_ROW_ID BIGINT, _ROW_TYPE STRING, _ROW_STATUS INT, _ROW_DATA STRING") \
        .option("header", True).option("sep", "|").option("lineSep", "\r\n").csv(folder)


def sink_exceptions(spark, sf_dir):
    folder = scratch_folder(spark, "exceptions")
    writers.write_exceptions(exception_rows(ledger_rows(spark, sf_dir, "orders")), folder, "overwrite")
    return spark.read.schema("_ROW_ID BIGINT, _ROW_TYPE STRING, _EXCEPTION_TYPE STRING, "
                             "_EXCEPTION_SOURCE STRING, _EXCEPTION_DESC STRING") \
        .option("header", True).option("sep", "|").option("lineSep", "\r\n").csv(folder)


def sink_diagnostic(spark, sf_dir):
    folder = scratch_folder(spark, "diagnostic")
    writers.write_if_any(accepted(ledger_rows(spark, sf_dir, "orders")), writers.write_diagnostic,
                         folder)
    return spark.read.schema("_ROW_ID BIGINT, _ROW_TYPE STRING, _ROW_DATA STRING") \
        .option("header", True).option("sep", "|").option("lineSep", "\r\n").csv(folder)


def sink_quarantine(spark, sf_dir):
    """Rows of a table source without a line go to the quarantine, the rest is transformed."""
    tune(spark)
    folder = scratch_folder(spark, "error")
    lines = ledger_lines(spark, sf_dir).withColumn(
        "value", F.when(F.col("_ROW_ID") % 23 != 0, F.col("value")))
    writers.write_quarantine(unreadable(lines), folder, "overwrite")
    quarantined = spark.read.schema("_ROW_ID BIGINT, value STRING").json(folder)
    good = transform(readable(lines), LEDGER)
    return quarantined.select("_ROW_ID", F.lit("quarantined").alias("route")).unionByName(
        good.select("_ROW_ID", F.when(F.col("_ROW_STATUS") == 0, "accepted")
                    .otherwise("rejected").alias("route")))


def sink_job(spark, sf_dir):
    """A whole run: lines of all memo record types in, every dataset out; rows per output."""
    source, out = scratch_folder(spark, "source"), scratch_folder(spark, "job")
    feed = FEEDS["memo_position"]
    feed_lines(spark, sf_dir, feed, "orders").select("value").write.mode("overwrite").text(source)
    job.run_feed(spark, feed, source, out, file_name=FILE_NAME)
    def count(folder, header):
        reader = spark.read.option("header", header).option("sep", "|").option("lineSep", "\r\n")
        rows = reader.csv(f"{out}/{folder}") if header else spark.read.text(f"{out}/{folder}")
        return rows.agg(F.lit(folder).alias("output"), F.count(F.lit(1)).alias("rows"))
    return (count("target", False).unionByName(count("rejected", True))
            .unionByName(count("exceptions", True)).unionByName(count("audit", True))
            .unionByName(count("audit_tab", True)))


def _two_files(spark, sf_dir) -> str:
    """Run the ledger feed over two files of very unequal size; the folder of its outputs."""
    source, out = scratch_folder(spark, "source"), scratch_folder(spark, "job")
    lines = ledger_lines(spark, sf_dir, "orders").withColumn(
        "part", F.when(F.col("_ROW_ID") % 50 == 0, "a").otherwise("b"))
    lines.repartitionByRange("part", "_ROW_ID").sortWithinPartitions("part", "_ROW_ID") \
        .select("value", "part").write.partitionBy("part").text(source)
    job.run_feed(spark, LEDGER, [f"{source}/part=a", f"{source}/part=b"], out, file_name=FILE_NAME,
                 inputs=job.Inputs(file_metadata=_metadata(spark)))
    return out


def _csv(spark, folder, schema, sep="|"):
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("lineSep", "\r\n").csv(folder)


def job_target_order(spark, sf_dir):
    """The target of a run, line by line over all its files: file after file, in source order."""
    return line_numbers(read_lines(spark, f"{_two_files(spark, sf_dir)}/target", origin=True)).select(
        F.col("_LINE_NO").alias("line_no"), "value")


def job_rejected(spark, sf_dir):
    rows = _csv(spark, f"{_two_files(spark, sf_dir)}/rejected",
                "_ROW_ID BIGINT, _ROW_TYPE STRING, _ROW_STATUS INT, _ROW_DATA STRING")
    return rows.select("_ROW_TYPE", "_ROW_STATUS", "_ROW_DATA")


def job_exceptions(spark, sf_dir):
    return _csv(spark, f"{_two_files(spark, sf_dir)}/exceptions",
                "_ROW_ID BIGINT, _ROW_TYPE STRING, _EXCEPTION_TYPE STRING, _EXCEPTION_SOURCE STRING, "
                "_EXCEPTION_DESC STRING").drop("_ROW_ID")


def _table_run(spark, sf_dir) -> str:
    """Run the ledger feed over a table in which some rows have no line."""
    out = scratch_folder(spark, "job")
    lines = ledger_lines(spark, sf_dir).withColumn("value", F.when(F.col("_ROW_ID") % 23 != 0, F.col("value")))
    job.run_feed(spark, LEDGER, lines, out, file_name=FILE_NAME, inputs=job.Inputs(file_metadata=_metadata(spark)))
    return out


def job_audit(spark, sf_dir):
    return _csv(spark, f"{_table_run(spark, sf_dir)}/audit",
                "REPORT_LINE_NO BIGINT, FILE_NAME STRING, ROW_TYPE STRING, REPORT_LINE_LABEL STRING, "
                "REPORT_RESULT_LABEL STRING, REPORT_RESULT_VALUE BIGINT", "\t")


def job_audit_tab(spark, sf_dir):
    names_ = [c.lower().replace(" ", "_") for c in RESULT_LABELS]
    return _csv(spark, f"{_table_run(spark, sf_dir)}/audit_tab", "report_line_no INT, file_name STRING, row_type STRING, "
                + ", ".join(f"{c} BIGINT" for c in names_), "\t")


def job_quarantine(spark, sf_dir):
    """What a run quarantines, and the identity rows in = out + rejected + quarantined."""
    out = _table_run(spark, sf_dir)
    return spark.read.schema("_ROW_ID BIGINT, value STRING").json(f"{out}/error")


UNDECODABLE_EVERY = 29   # every 29th line of the source gets two Latin-1 letters in place of two characters


def undecodable_source(spark, sf_dir) -> str:
    """Ledger lines of ``customer`` as a text file in which some lines are no UTF-8: bytes E9 FC at 30-31."""
    source = scratch_folder(spark, "source")
    raw = F.encode("value", "UTF-8")
    bad = F.concat(F.substring(raw, 1, 29), F.unhex(F.lit("E9FC")), F.substring(raw, 32, 1 << 20))
    value = F.when(F.col("_ROW_ID") % UNDECODABLE_EVERY == 0, bad).otherwise(raw).cast("string")
    ledger_lines(spark, sf_dir).select(value.alias("value")).write.text(source)
    return source


def job_undecodable(spark, sf_dir):
    """A run over a text file with lines that are no UTF-8: lines in, and lines of every output."""
    source, out = undecodable_source(spark, sf_dir), scratch_folder(spark, "job")
    job.run_feed(spark, LEDGER, source, out, file_name=FILE_NAME, encoding="UTF-8",
                 inputs=job.Inputs(file_metadata=_metadata(spark)))
    def count(output, rows):
        return rows.agg(F.lit(output).alias("output"), F.count(F.lit(1)).alias("rows"))
    return (count("in", spark.read.text(source))
            .unionByName(count("target", spark.read.text(f"{out}/target")))
            .unionByName(count("rejected", _csv(spark, f"{out}/rejected", "_ROW_ID BIGINT")))
            .unionByName(count("quarantined", spark.read.schema("_ROW_ID BIGINT, value STRING, _BYTES STRING")
                               .json(f"{out}/error").where(F.col("_BYTES").isNotNull()))))


NATION_BY_NAME = "n_nationkey BIGINT, n_name STRING, n_regionkey BIGINT"


def meta_by_name(spark, sf_dir):
    """``nation`` as two pipe files of other column orders, one without names, read back by name."""
    tune(spark)
    folder = scratch_folder(spark, "by-name")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    even = F.col("n_nationkey") % 2 == 0
    writers.write_pipe_csv(nation.where(even).select("n_regionkey", "n_name", "n_nationkey")
                           .coalesce(1), f"{folder}/a", "overwrite")
    writers.write_pipe_csv(nation.where(~even).select(F.col("n_regionkey").alias("N_REGIONKEY"), "n_nationkey")
                           .coalesce(1), f"{folder}/b", "overwrite")
    return tables.read_by_name(spark, [f"{folder}/a", f"{folder}/b"], NATION_BY_NAME)


def fw_lookup_duplicates(spark, sf_dir):
    """A given lookup with repeated keys: one row per line all the same, the last in order counts."""
    tune(spark)
    twice = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.expr("substr('1234567890X', n_nationkey % 11 + 1, 1)").alias("k"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("v"), "n_nationkey")
    lookup, _ = checked_lookup(tables.unique_lookup(twice, ("n_nationkey",)))
    rows = transform(ledger_lines(spark, sf_dir), LEDGER, {"account_type": lookup})
    return rows.select("_ROW_ID", "_ROW_STATUS", "_ROW_DATA")


def fw_lookup_large(spark, sf_dir):
    """A lookup beyond the bound of a broadcast: an ordinary join; lines without a key are spread."""
    tune(spark)
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.expr("substr('1234567890X', n_nationkey % 11 + 1, 1)").alias("k"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("v"), "n_nationkey")
    lookup, small = checked_lookup(tables.unique_lookup(nation, ("n_nationkey",)), max_rows=5)
    assert not small
    rows = transform(ledger_lines(spark, sf_dir), LEDGER, {"account_type": lookup.hint("merge")})
    return rows.select("_ROW_ID", "_ROW_STATUS", "_ROW_DATA")


def source_table_lines(spark, sf_dir):
    """Lines from a catalog table."""
    ledger_lines(spark, sf_dir, "orders").createOrReplaceTempView("feedloom_order_lines")
    rows = transform(table_lines(spark, "feedloom_order_lines"), LEDGER)
    return rows.groupBy("_ROW_TYPE", "_ROW_STATUS").agg(F.count(F.lit(1)).alias("n"))


# --- audit -----------------------------------------------------------------------------------------

def _metadata(spark):
    return tables.pipe_text(spark, LEDGER_TYPES, tables.FILE_METADATA)


def _inputs(spark):
    return job.Inputs(file_metadata=_metadata(spark)).filled(spark, LEDGER)


def audit_counts(spark, sf_dir):
    return audit.routed_counts(ledger_rows(spark, sf_dir, "lineitem")).select(
        "section", F.col("_ROW_TYPE").alias("row_type"), F.col("count").alias("n"))


def audit_totals(spark, sf_dir):
    """Rows in, counted directly and as the sum of the counts per type."""
    rows = ledger_rows(spark, sf_dir, "orders")
    return audit.row_count(rows).select(F.lit("counted").alias("how"), F.col("count").alias("n")) \
        .unionByName(audit.total(audit.type_counts(rows)).select(
            F.lit("summed").alias("how"), F.col("count").alias("n")))


def audit_weighted_unpivot(spark, sf_dir):
    out = audit.type_counts(accepted(ledger_rows(spark, sf_dir, "lineitem")))
    return audit.weighted_counts(out, _metadata(spark)).select(
        F.col("_ROW_TYPE").alias("row_type"), F.col("_REPORT_SECTION").alias("section"),
        F.col("_REPORT_RESULT_VALUE").alias("n"))


def audit_exception_categories(spark, sf_dir):
    failed = exception_rows(ledger_rows(spark, sf_dir))
    return audit.category_counts(failed, job.default_exception_metadata(spark)).select(
        F.col("_ROW_TYPE").alias("row_type"), F.col("EXCEPTION_CATEGORY").alias("category"),
        F.col("count").alias("n"))


def audit_values(spark, sf_dir):
    counted = audit.tally(ledger_rows(spark, sf_dir, "lineitem"))
    return audit.audit_values(counted, _metadata(spark), job.default_exception_metadata(spark),
                              complete=True).select(
        F.col("_REPORT_SECTION").alias("section"), F.col("_REPORT_LEVEL").alias("level"),
        F.col("_ROW_TYPE").alias("row_type"), F.col("_REPORT_RESULT_VALUE").alias("n"))


def _report(spark, sf_dir, table):
    return job.audit_report(ledger_rows(spark, sf_dir, table), _inputs(spark), FILE_NAME)


def audit_report_long(spark, sf_dir):
    return audit.long_report(_report(spark, sf_dir, "customer"))


def audit_report_tabular(spark, sf_dir):
    tab = audit.tabular_report(_report(spark, sf_dir, "customer"))
    return tab.select(*(F.col(c).alias(c.lower().replace(" ", "_")) for c in tab.columns))


def feed_audit(spark, sf_dir, feed: Feed) -> DataFrame:
    """The tabular audit of a real feed; nothing but types and statuses is worked out."""
    tab = audit.tabular_report(job.audit_report(
        outcomes(feed_lines(spark, sf_dir, feed), feed), job.Inputs().filled(spark, feed), FILE_NAME))
    return tab.select(*(F.col(c).alias(c.lower().replace(" ", "_")) for c in tab.columns))


# --- splitting and files --------------------------------------------------------------------------

def type_split_trim(spark, sf_dir):
    lines = feed_lines(spark, sf_dir, FEEDS["memo_position"], "orders")
    sheet = sheet_table(lines, "1")
    return sheet.select("_ROW_ID", "c1", "c2", "c3", "c6", "c8", "c9", "c10", "c11", "c21", "c22")


def type_split_cells(spark, sf_dir):
    """All sheets in one pass, written to one folder per sheet and read back."""
    folder = scratch_folder(spark, "sheets")
    lines = feed_lines(spark, sf_dir, FEEDS["memo_position"], "lineitem")
    writers.write_split(split_cells(lines), folder)
    rows = spark.read.text(folder).select(F.col("_SHEET").cast("string").alias("sheet"), "value")
    return rows.groupBy("sheet", F.size(F.split("value", "\\|")).alias("cells")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("characters"))


def file_manifest(spark, sf_dir):
    tune(spark)
    return files.manifest(files.list_files(spark, sf_dir)).select(
        names.base_name(F.col("original_key")).alias("original_name"), "new_name", "size_bytes")


def destination_names(spark, sf_dir):
    orders = _sql(spark, sf_dir,
                  "SELECT o_orderkey, 'in/' || o_orderstatus || '/f.' || CAST(o_orderkey AS STRING)"
                  " || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '.txt' END AS path, o_orderdate,"
                  " CASE o_orderkey % 5 WHEN 0 THEN 'Z' WHEN 1 THEN '+05:30' WHEN 2 THEN '-0800'"
                  " WHEN 3 THEN 'UTC' ELSE 'local' END AS zone,"
                  " CASE o_orderkey % 4 WHEN 0 THEN 'drop' WHEN 1 THEN ' KEEP' WHEN 2 THEN 'force:csv'"
                  " ELSE 'force:.dat' END AS mode FROM {orders}", "orders")
    stamp = names.stamp(F.col("o_orderdate"), F.col("zone"))
    return orders.select(
        "o_orderkey", names.destination_name(F.col("path"), stamp, F.col("mode")).alias("new_name"),
        names.folder(F.regexp_extract("path", "^(.*/)", 1)).alias("folder"))


# --- the real feeds ----------------------------------------------------------------------------------

def _feed_query(feed: Feed, build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(feed_rows(spark, sf_dir, feed))


def _all_columns(rows):
    return rows.select("_ROW_ID", "_ROW_TYPE", "_ROW_STATUS", "_ROW_DATA")


SINGLE = (fw_extract, fw_typed_structs, fw_length_reject, fw_classify, fw_xref_join,
          fw_xref_exchange_class, fw_code_map, fw_table_lookup, fw_filler_check,
          fw_status_last_wins, fw_route_accepted, fw_route_rejected, fw_render_pipe, fw_exceptions,
          fw_failure_text, fw_split_failure_text, fw_roundtrip_sorted, fw_source_order, sink_rejected,
          sink_exceptions, sink_diagnostic, sink_quarantine, sink_job, source_table_lines,
          audit_counts, audit_totals, audit_weighted_unpivot, audit_exception_categories, audit_values,
          audit_report_long, audit_report_tabular, type_split_trim,
          job_target_order, job_rejected, job_exceptions, job_audit, job_audit_tab, job_quarantine, job_undecodable, meta_by_name,
          fw_lookup_duplicates, fw_lookup_large,
          type_split_cells, file_manifest, destination_names)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {q.__name__: q for q in SINGLE}
    for feed in FEEDS.values():
        out[f"{feed.name}_transform"] = _feed_query(feed, _all_columns)
        out[f"{feed.name}_exceptions"] = _feed_query(feed, exception_rows)
        out[f"{feed.name}_audit"] = lambda spark, sf_dir, feed=feed: feed_audit(spark, sf_dir, feed)
    for name in CORRECTIONS:
        out[f"{name}_strict_transform"] = _feed_query(STRICT_FEEDS[name], _all_columns)
    return out
