"""Source contract as column expressions (A6-A9, A15 parsing, F26 capacity).

Everything here is a built-in expression: splitting, validation, payload and
fingerprint run inside whole-stage codegen, no Python per row.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C

# --- Fixed values ------------------------------------------------------------------
# Characters Python's str.strip() removes (ASCII and Unicode whitespace).
STRIP_CHARS = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0     "
               "           　")
# One strictly quoted CSV field: quoted with doubled quotes, or unquoted not starting
# with a quote (a quote later in an unquoted field is legal), or empty.
FIELD = r'(?:"(?:[^"]|"")*"|[^",][^,]*|)'
STRICT_LINE = rf"^{FIELD}(?:,{FIELD})*$"
# Applied to "," + line: every field is preceded by a comma, so each match consumes at
# least that comma (an empty first field cannot hide the next delimiter).
FIELD_EXTRACT = r',("(?:[^"]|"")*"|[^",][^,]*|)'
# Decimal text after stripping and removing digit-group underscores.
DECIMAL_TEXT = r"^[+-]?(?:(\d+)(?:\.(\d*))?|\.(\d+))(?:[eE]([+-]?\d+))?$"
TIMESTAMP_FORMATS = ((r"^(?!0000)\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}$", "y/M/d H:m"),
                     (r"^(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "y-M-d H:m:s"))
# A zero mantissa: the value is 0 whatever the exponent (a cast would overflow on 0E+174).
ZERO_TEXT = r"^[+-]?0*\.?0*(?:[eE][+-]?\d+)?$"
# ---------------------------------------------------------------------------------


def strip(c: Column) -> Column:
    """Python-style strip of surrounding whitespace."""
    return F.btrim(c, F.lit(STRIP_CHARS))


def is_strict_csv(line: Column) -> Column:
    return line.rlike(STRICT_LINE)


def split_fields(line: Column) -> Column:
    """Split one physical CSV line into unquoted values (empty line -> 0 values).

    Lines without a quote use a plain split; quoted lines use a field regex, then
    the quotes are removed and doubled quotes collapsed.
    """
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(FIELD_EXTRACT), 1)
    unquote = F.transform(quoted, lambda x: F.when(
        x.startswith('"'), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    ).otherwise(x))
    return (F.when(line == "", F.array().cast("array<string>"))
            .when(F.instr(line, '"') == 0, F.split(line, ",", -1))
            .otherwise(unquote))


def parse_timestamp(text: Column) -> tuple[Column, Column]:
    """(valid, timestamp_ntz) for 'Y/m/d H:M' or 'Y-m-d H:M:S' (unpadded fields allowed)."""
    t = F.regexp_replace(strip(text), r"\s+", " ")
    valid = F.lit(False)
    value = F.lit(None).cast("timestamp_ntz")
    for gate, fmt in reversed(TIMESTAMP_FORMATS):
        ok = t.rlike(gate) & F.try_to_timestamp(t, F.lit(fmt)).isNotNull()
        valid = ok | valid
        value = F.when(ok, F.to_timestamp_ntz(t, F.lit(fmt))).otherwise(value)
    return valid, value


def ascii_digits(text: Column) -> Column:
    """Decimal digits of any script as 0-9 (a table by rule: every code point of category Nd)."""
    other = [chr(i) for i in range(0x80, 0x20000) if unicodedata.category(chr(i)) == "Nd"]
    plain = "".join(str(unicodedata.digit(c)) for c in other)
    return F.when(text.rlike(r"\p{Nd}") & text.rlike(r"[^\x00-\x7f]"), F.translate(text, "".join(other), plain)).otherwise(text)


def amount_text(text: Column) -> Column:
    return ascii_digits(F.replace(strip(text), F.lit("_"), F.lit("")))


def written_exponent(text: Column) -> Column:
    """Exponent of the decimal as written: exponent part minus fraction digits."""
    t = amount_text(text)
    m = F.regexp_extract
    frac = F.length(F.coalesce(F.nullif(m(t, DECIMAL_TEXT, 2), F.lit("")), m(t, DECIMAL_TEXT, 3)))
    exp = F.coalesce(F.nullif(m(t, DECIMAL_TEXT, 4), F.lit("")).try_cast("decimal(38,0)"), F.lit(0))
    return exp - frac


def amount_value(text: Column) -> Column:
    t = amount_text(text)
    return F.when(t.rlike(ZERO_TEXT), F.lit(0).cast("decimal(24,6)")).otherwise(t.try_cast("decimal(24,6)"))


def field(values: Column, i: int) -> Column:
    return F.get(values, i)


def amount_checks(t: Column, currency: Column) -> Column:
    """Finite, >= 0, < 1e18 and written with at most 2 (Bitcoin: 6) decimals; for a stripped, underscore-free text.

    The written scale is the exponent of the text (fraction digits minus the
    exponent), so '1.000' is too precise for dollars although it equals 1.
    """
    m = F.regexp_extract
    frac = F.length(F.coalesce(F.nullif(m(t, DECIMAL_TEXT, 2), F.lit("")), m(t, DECIMAL_TEXT, 3)))
    exp = F.coalesce(F.nullif(m(t, DECIMAL_TEXT, 4), F.lit("")).try_cast("decimal(38,0)"), F.lit(0))
    value = t.try_cast("decimal(38,6)")
    scale = F.when(currency == C.HIGH_SCALE_CURRENCY, C.HIGH_SCALE).otherwise(C.DEFAULT_SCALE)
    in_range = value.isNotNull() & (value >= 0) & (value < F.lit(C.AMOUNT_LIMIT).cast("decimal(38,6)"))
    return F.coalesce(t.rlike(DECIMAL_TEXT) & (exp - frac >= -scale) & (t.rlike(ZERO_TEXT) | in_range),
                      F.lit(False))


def parse_frame(df: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """A6-A9 on a frame of raw lines: adds reason_codes, payload, record_hash.

    Staged projections: the split runs once per line and every check reads the
    split columns (Catalyst keeps an expensive expression from being inlined into
    several consumers), so the per-line cost is one regex gate plus cheap tests.
    """
    line = F.col(text_col)
    keep = df.columns
    s1 = df.withColumn("_strict", is_strict_csv(line))
    s2 = s1.withColumn("_values", F.when(F.col("_strict"), split_fields(line)))
    vals = F.col("_values")
    fcols = [strip(field(vals, i)).alias(f"_f{i}") for i in range(len(C.KEYS))]
    s3 = s2.select(*keep, "_strict", F.size(vals).alias("_width"), *fcols)
    f = lambda i: F.col(f"_f{i}")
    ts_text = F.regexp_replace(f(0), r"\s+", " ")
    s4 = s3.withColumn("_ts", ts_text) \
        .withColumn("_a5", ascii_digits(F.replace(f(5), F.lit("_"), F.lit("")))) \
        .withColumn("_a7", ascii_digits(F.replace(f(7), F.lit("_"), F.lit(""))))
    ts_ok = F.lit(False)
    for gate, fmt in TIMESTAMP_FORMATS:
        ts_ok = ts_ok | (F.col("_ts").rlike(gate) & F.try_to_timestamp(F.col("_ts"), F.lit(fmt)).isNotNull())
    checks = [F.when(~ts_ok, F.lit("invalid_timestamp"))]
    for idx, name in ((1, "from_bank"), (2, "from_account"), (3, "to_bank"), (4, "to_account"),
                      (6, "receiving_currency"), (8, "payment_currency"), (9, "payment_format")):
        checks.append(F.when(F.length(f(idx)) == 0, F.lit(f"missing_{name}")))
    checks.append(F.when(~amount_checks(F.col("_a5"), f(6)), F.lit("invalid_amount_received")))
    checks.append(F.when(~amount_checks(F.col("_a7"), f(8)), F.lit("invalid_amount_paid")))
    checks.append(F.when(~f(10).isin("0", "1"), F.lit("invalid_laundering_label")))
    reasons = (F.when(~F.col("_strict"), F.array(F.lit(C.MALFORMED_REASON)))
               .when(F.col("_width") != len(C.HEADERS), F.array(F.lit(C.WIDTH_REASON)))
               .otherwise(F.array_compact(F.array(*checks))))
    payload_col = F.struct(*[F.when(F.col("_strict") & (F.col("_width") > i), f(i)).alias(k)
                             for i, k in enumerate(C.KEYS)])
    s5 = s4.select(*keep, reasons.alias("reason_codes"), payload_col.alias("payload"))
    return s5.withColumn("record_hash", record_hash(F.col("payload")))


def record_hash(payload_col: Column) -> Column:
    """SHA-256 of the compact, sorted-key JSON of the payload (absent keys omitted)."""
    sorted_struct = F.struct(*[payload_col.getField(k).alias(k) for k in sorted(C.KEYS)])
    return F.sha2(F.to_json(sorted_struct), 256)


def typed_columns(p: Column) -> list[Column]:
    """Staging types from a payload struct (accepted rows only)."""
    _, ts = parse_timestamp(p.getField("timestamp"))
    return [
        ts.alias("event_time"),
        p.getField("from_bank").alias("from_bank_code"),
        p.getField("from_account").alias("from_account_code"),
        p.getField("to_bank").alias("to_bank_code"),
        p.getField("to_account").alias("to_account_code"),
        amount_value(p.getField("amount_received")).alias("amount_received"),
        p.getField("receiving_currency").alias("receiving_currency"),
        amount_value(p.getField("amount_paid")).alias("amount_paid"),
        p.getField("payment_currency").alias("payment_currency"),
        p.getField("payment_format").alias("payment_format"),
        (p.getField("is_laundering") == "1").alias("is_laundering"),
    ]


def capacity_ok(text: Column, max_scale: int = 12) -> Column:
    """the text amount fits decimal(38,12) exactly: a finite number >= 0,
    written scale <= 12 and below 1e26 (a failed cast means it does not fit)."""
    t = amount_text(text)
    value = t.try_cast("decimal(38,12)")
    return F.coalesce(t.rlike(DECIMAL_TEXT) & (written_exponent(text) >= -max_scale)
                      & value.isNotNull() & (value >= 0), F.lit(False))
