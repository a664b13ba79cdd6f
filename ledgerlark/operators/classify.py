"""Row classification, quarantine and manifest counts.

A row is ``rejected`` when it has reasons. Among valid rows, the first occurrence
of a payload hash (in file, then row order) is ``accepted`` unless an accepted row
with that hash was loaded before; every other valid copy is a
``duplicate_candidate``. The first occurrence is found with a partial aggregate
per hash joined back (AQE splits a hot hash on the join), not with a window that
would put all copies of a hot payload in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import contract
from ..session import written
from .scale import assign_ids


def parse_lines(lines: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """A6-A9 on a frame of raw lines: adds reason_codes, payload, record_hash."""
    return contract.parse_frame(lines, text_col)


def parse_corrections(lines: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """Correction lines split once, then tested in contract order: CSV form, width, target, the 11 fields.
    Adds target_raw_record_id, payload, record_hash and ``error`` (null for a good row)."""
    line, width = F.col(text_col), len(C.HEADERS) + 1
    rows = lines.withColumn("_strict_line", contract.is_strict_csv(line))
    rows = rows.withColumn("_fields", F.when(F.col("_strict_line"), contract.split_fields(line)))
    whole = F.size("_fields") == width
    quoted = F.transform(F.slice("_fields", 2, width - 1), lambda x: F.when(
        x.rlike('[",]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x))
    target = contract.strip(F.get(F.col("_fields"), F.lit(0)))
    number = F.when(target.rlike(r"^[+-]?\d+(?:_\d+)*$"), F.replace(target, F.lit("_"), F.lit("")).try_cast("long"))
    rows = rows.withColumn("_rest", F.when(whole, F.concat_ws(",", quoted)).otherwise(F.lit(""))) \
        .withColumn("target_raw_record_id", F.when(whole, number))
    parsed = parse_lines(rows, "_rest")
    error = (F.when(~F.col("_strict_line"), F.lit(C.MALFORMED_REASON))
             .when(F.size("_fields") != width, F.lit("wrong_column_count"))
             .when(F.coalesce(F.col("target_raw_record_id"), F.lit(0)) <= 0, F.lit("invalid_target_id"))
             .when(F.size("reason_codes") > 0, F.array_join("reason_codes", ",")))
    return parsed.withColumn("error", error).drop("_strict_line", "_fields", "_rest", "reason_codes")


def classify(parsed: DataFrame, accepted_hashes: DataFrame | None = None,
             order_cols: tuple[str, ...] = ("file_id", "source_row_number")) -> DataFrame:
    """A10: validation_status and final reason codes for one incoming batch.

    The parse is written once; the first occurrences come from its narrow columns. ``accepted_hashes``: hashes
    that were accepted before (see ``hashindex.seen``).
    """
    return classify_parsed(written(parsed, "parsed"), accepted_hashes, order_cols)


def classify_parsed(parsed: DataFrame, accepted_hashes: DataFrame | None = None,
                    order_cols: tuple[str, ...] = ("file_id", "source_row_number")) -> DataFrame:
    """A10 over a parse that is stored already: it is read twice."""
    valid = F.size("reason_codes") == 0
    first = (parsed.filter(valid).groupBy("record_hash").agg(F.min(F.struct(*order_cols)).alias("_first")))
    if accepted_hashes is not None:
        seen = accepted_hashes.select("record_hash").distinct().withColumn("_seen", F.lit(True))
        first = first.join(seen, "record_hash", "left")
    else:
        first = first.withColumn("_seen", F.lit(False))
    j = parsed.join(first, "record_hash", "left").select(*parsed.columns, "_first", "_seen")
    is_first = F.coalesce(F.struct(*order_cols) == F.col("_first"), F.lit(False))
    status = (F.when(~valid, F.lit(C.REJECTED))
              .when(is_first & ~F.coalesce(F.col("_seen"), F.lit(False)), F.lit(C.ACCEPTED))
              .otherwise(F.lit(C.DUPLICATE)))
    reasons = F.when(status == C.DUPLICATE, F.array(F.lit(C.DUPLICATE_REASON))).otherwise(F.col("reason_codes"))
    return (j.withColumn("validation_status", status)
             .withColumn("reason_codes", reasons)
             .drop("_first", "_seen"))


def missing_targets(corrections: DataFrame, raw: DataFrame) -> DataFrame:
    """Corrections whose target_raw_record_id is not an accepted row of ``raw``."""
    accepted = raw.filter(F.col("validation_status") == C.ACCEPTED).select(F.col("raw_record_id").alias("target_raw_record_id"))
    return corrections.join(accepted, "target_raw_record_id", "left_anti")


def quarantine(raw: DataFrame) -> DataFrame:
    """Every non-accepted row with reasons and raw text."""
    cols = [c for c in ("raw_record_id", "file_id", "source_row_number", "reason_codes", "raw_text")
            if c in raw.columns]
    return raw.filter(F.col("validation_status") != C.ACCEPTED).select(*cols)


def manifest_counts(raw: DataFrame) -> DataFrame:
    """Per file total / accepted / rejected / duplicate counts."""
    s = F.col("validation_status")
    return raw.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(s == C.ACCEPTED).alias("accepted_rows"),
        F.count_if(s == C.REJECTED).alias("rejected_rows"),
        F.count_if(s == C.DUPLICATE).alias("duplicate_candidates"))


def with_raw_ids(classified: DataFrame, start_after: int = 0) -> DataFrame:
    """raw_record_id ascending in (file, row) order after ``start_after``."""
    return assign_ids(classified, ["file_id", "source_row_number"], "raw_record_id", start_after)
