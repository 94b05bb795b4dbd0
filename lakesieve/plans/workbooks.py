"""Sheet sets to silver tables and the warehouse, with checkpoints."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..contracts import CHECKPOINT, SHEET_REJECT
from ..functions.text import checkpoint_code, fiscal_year, kebab_name, snake_name, split_label, stored_code
from ..operators.columns import cast_if_present
from ..operators.isolation import TABLE_ERRORS, raise_if_lost
from ..operators.layouts import OUTPUT_TAG, SHEET_TAG, OutputSet, SheetLayout, layouts_of, prepare_layout, united_outputs
from ..operators.unions import sheet_categories
from ..sinks.files import replace_each, silver_path
from ..sinks.upsert import ChangeLog, upsert
from ..sources.files import read_table
from .copying import Schema

log = logging.getLogger(__name__)

# The group names of checkpoints.
STAGES = ("Ingestion", "Transformation", "Loading")
MODES = ("all", "labelled", "category", "each")
CHECKPOINT_KEYS = ("group_name", "code")
CHECKPOINT_UPDATES = ("data_upto_ts", "updated_at", "updated_by")

#: The one output of a mode that unions all sheets.
ALL = "__all__"

# Workbook headers whose new name is not their snake case.
WORKBOOK_HEADERS = {
    "eventno": "event_no",
    "eventname": "event_name",
    "accesscode": "access_code_id",
    "Access Code": "access_code_name",
    "discno": "discount_no",
    "discamt": "discount_amount",
    "descr": "description",
    "price": "price",
    "tkt_qty": "ticket_qty",
    "TK Status": "ticket_status",
    "category": "category_id",
    "subcat": "sub_category_id",
    "Title 1?": "title",
    "charter?": "charter",
    "Street1": "street_1",
    "StartDateTime": "start_datetime",
    "OrderNo": "order_no",
    "PromotionCode": "promotion_code",
    "FirstName": "first_name",
    "LastName": "last_name",
    "Usedate": "use_date",
    "GiftMemStatus": "gift_membership_status",
    "DiscAmt": "discount_amount",
    "Rev": "revenue",
    "usedate": "use_date",
    "eventdate": "event_date",
    "eventid": "event_id",
    "facilityname": "facility_name",
    "nodenumber": "node_number",
}


def _prepared(layouts: Sequence[SheetLayout], mode: str, mapping) -> tuple[list[SheetLayout], list[tuple[str, str]]]:
    """The layouts that can be prepared, and (sheet, reason) of the sheets of the others."""
    ready, rejected = [], []
    for layout in layouts:
        try:
            layout = prepare_layout(layout, mapping)
        except (ValueError, PySparkException) as error:
            rejected += [(name, str(error)) for name in layout.sheets]
            continue
        rows, sheet = layout.rows, F.col(SHEET_TAG)
        if mode == "labelled":
            code, year = split_label(sheet)
            rows = cast_if_present(rows.withColumns({"museum_code": code, "fiscal_year": year}), "event_date")
        elif mode == "all":
            rows = rows.withColumn("fiscal_year", sheet)
        elif mode == "category":
            rows = rows.withColumn("fiscal_year", fiscal_year(sheet))
        ready.append(SheetLayout(layout.sheets, rows))
    return ready, rejected


def _output_names(spark: SparkSession, sheets: Sequence[str], mode: str) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Sheet -> output (ALL for the only one), and the sheets whose output another one has already."""
    if mode == "category":
        return {s: c for c, names in sheet_categories(spark, list(sheets)).items() for s in names}, []
    if mode != "each":
        return dict.fromkeys(sheets, ALL), []
    names, rejected, taken = {}, [], set()
    for sheet in sheets:
        output = kebab_name(sheet)
        if output in taken:
            rejected.append((sheet, f"two sheets would be written as {output!r}"))
        else:
            taken.add(output)
            names[sheet] = output
    return names, rejected


def _outputs(
    spark: SparkSession, sheets: Sequence[str], layouts: Sequence[SheetLayout], mode: str, mapping
) -> tuple[list[OutputSet], list[tuple[str, str]]]:
    ready, rejected = _prepared(layouts, mode, mapping)
    usable = {s for layout in ready for s in layout.sheets}
    names, clashes = _output_names(spark, [s for s in sheets if s in usable], mode)
    outputs, others = united_outputs(ready, names) if names else ([], [])
    return outputs, rejected + clashes + others


def _written(
    outputs: OutputSet, paths: Mapping[str, str]
) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """Rows per output that was written, and (output, reason) of the others.

    All outputs are one write. Only if that fails they are written one by one, so that the one whose
    rows break it holds up no other.
    """
    try:
        return replace_each(outputs.rows, OUTPUT_TAG, paths), []
    except TABLE_ERRORS as error:
        raise_if_lost(outputs.rows.sparkSession, error)
        if len(paths) == 1:
            log.exception("writing %s failed", *paths)
            return {}, [(name, str(error)) for name in paths]
    counts, failed = {}, []
    for name, path in paths.items():
        try:
            counts |= replace_each(outputs.rows, OUTPUT_TAG, {name: path})
        except TABLE_ERRORS as error:
            raise_if_lost(outputs.rows.sparkSession, error)
            log.exception("writing %s failed", name)
            failed.append((name, str(error)))
    return counts, failed


def checkpoint_changes(
    spark, finished: list[tuple[str, str, str | None]], source: str, as_of: datetime, user: str
) -> DataFrame:
    """Checkpoint rows for (stage, key, sub_key) steps that were finished at ``as_of``."""
    steps = spark.createDataFrame(finished, "group_name string, key string, sub string")
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return steps.select(
        "group_name",
        F.lit(None).cast("string").alias("name"),
        stored_code("group_name", checkpoint_code(F.lit(source), "key", "sub")).alias("code"),
        now.alias("data_upto_ts"),
        F.lit("").alias("note"),
        now.alias("created_at"), now.alias("updated_at"),
        F.lit(user).alias("created_by"), F.lit(user).alias("updated_by"),
    )


def checkpoint_log(spark: SparkSession, path: str) -> ChangeLog:
    """The checkpoints stored at ``path`` as appended changes."""
    return ChangeLog(spark, path, CHECKPOINT, CHECKPOINT_KEYS, CHECKPOINT_UPDATES)


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """The stored checkpoints; none before the first run."""
    return checkpoint_log(spark, path).read()


def update_checkpoints(checkpoints: DataFrame, changes: DataFrame) -> DataFrame:
    return upsert(checkpoints, changes, CHECKPOINT_KEYS, CHECKPOINT_UPDATES)


def sheets_job(
    sheets: Mapping[str, DataFrame] | Sequence[SheetLayout],
    source: str,
    file_name: str,
    base: str,
    as_of: datetime,
    user: str,
    mode: str = "each",
    warehouse: Schema | None = None,
    checkpoints: DataFrame | None = None,
    mapping: Mapping[str, str] | None = None,
    checkpoint_path: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write a workbook's sheets to silver, load the warehouse, move the checkpoints.

    Modes: ``all`` unions every sheet and keeps the sheet name as fiscal year; ``labelled`` does
    too but splits names like "Hart FY20" into museum code and year; ``category`` unions per label
    category; ``each`` writes every sheet on its own. Returns (outputs, checkpoints, rejected
    sheets). ``source`` names the system the workbook comes from, in table names and checkpoint
    codes. The warehouse loads what silver stored, so a sheet is computed once.

    ``sheets`` are DataFrames by name, or layouts as :func:`read_layouts` gives them, which are
    scanned once each. Outputs with the same columns are one partitioned write, in which their rows
    are counted.

    A sheet that cannot be prepared, has other columns than its output, or would be written over
    another one's output is rejected with the reason, and so is an output that cannot be written; the
    job goes on. With ``checkpoint_path`` each stage appends its checkpoints there, so a later
    failure forgets none, and the log is compacted at the end; otherwise ``checkpoints`` is moved
    and returned.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    layouts = layouts_of(sheets) if isinstance(sheets, Mapping) else list(sheets)
    names = list(sheets) if isinstance(sheets, Mapping) else [s for layout in layouts for s in layout.sheets]
    spark = layouts[0].rows.sparkSession
    sets, rejected = _outputs(spark, names, layouts, mode, WORKBOOK_HEADERS if mapping is None else mapping)
    lines, steps = [], []
    stored_log = checkpoint_log(spark, checkpoint_path) if checkpoint_path is not None else None

    def finished(stage: str, outputs: Iterable[str]) -> None:
        done = [(stage, file_name, None if output == ALL else output) for output in outputs]
        steps.extend(done)
        if stored_log is not None and done:
            stored_log.append(checkpoint_changes(spark, done, source, as_of, user))

    def load(output: str, path: str) -> None:
        name = file_name if output == ALL else f"{file_name}_{output}"
        warehouse.replace(read_table(spark, path), f"{source}_{snake_name(name)}")
        finished(STAGES[2], [output])

    for outputs in sets:
        paths = {o: silver_path(base, file_name, None if o == ALL else o) for o in outputs.outputs}
        counts, failed = _written(outputs, paths)
        finished(STAGES[1], counts)
        for output, rows in counts.items():
            try:
                if warehouse is not None:
                    load(output, paths[output])
                lines.append(Row(category="" if output == ALL else output, path=paths[output], row_count=rows))
            except TABLE_ERRORS as error:
                raise_if_lost(spark, error)
                log.exception("loading %s of %s failed", output, file_name)
                failed.append((output, str(error)))
        rejected += [(file_name if output == ALL else output, reason) for output, reason in failed]
    written = spark.createDataFrame(lines, "category string, path string, row_count long")
    if stored_log is not None:
        if steps:
            stored_log.compact()
        moved = stored_log.read()
    else:
        known = checkpoints if checkpoints is not None else spark.createDataFrame([], CHECKPOINT)
        moved = update_checkpoints(known, checkpoint_changes(spark, steps, source, as_of, user))
    return written, moved, spark.createDataFrame(rejected, SHEET_REJECT)
