"""Secret scans by a trigram inverted index. DataFrame functions only.

Each rule's pattern is turned into a Boolean trigram query. The index has a posting (trigram,
document) for every trigram that some rule asks for. Postings are intersected per rule and
alternative (a bit per trigram, OR-ed by a partial aggregate), which leaves each rule its candidate
documents. Candidates are verified with the pattern itself; rules without a mandatory trigram scan
every document. Matches are leftmost and do not overlap within a kind; offsets are code points, end
exclusive.

Edge cases. Null texts count as empty and have no spans. Rows are told apart by ID and text hash
(nulls equal), so repeated rows and IDs each get their own result. An empty table gives an empty
result. Texts of any length are scanned whole. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, trigrams


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` of a match needs ``least`` characters. Patterns are plain ASCII ones."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


BASE = (
    Rule("assign", f"({'|'.join(map(either_case, ('password', 'passwd', 'secret', 'token', 'api_?key')))})"
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
)
RULES = BASE + MORE
SPAN = "array<struct<start:int,kind:int,stop:int>>"


def terms(rules=RULES) -> list[tuple[int, int, str, int, int]]:
    """(rule, alternative, trigram, its bit, all bits) for rules that have mandatory trigrams."""
    out = []
    for r, rule in enumerate(rules):
        alternatives = trigrams.query(rule.pattern)
        if () in alternatives:
            continue
        for a, grams in enumerate(alternatives):
            out += [(r, a, g, 1 << i, (1 << len(grams)) - 1) for i, g in enumerate(grams)]
    return out


def _keyed(documents: DataFrame) -> DataFrame:
    text = common.text_or_empty()
    return documents.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"))


def index(documents: DataFrame, grams: list[str]) -> DataFrame:
    """Inverted index: a posting (trigram, doc_id, text_key) for each of ``grams`` in a document."""
    asked = F.array(*map(F.lit, grams)) if grams else F.expr("cast(array() as array<string>)")
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(asked, lambda g: F.contains(low, g)))[0]
    return _keyed(documents).select(F.explode(held).alias("trigram"), "doc_id", "text_key")


def candidates(postings: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, text_key, rules): the indexed rules whose trigram query a document meets."""
    spark = postings.sparkSession
    asked = spark.createDataFrame(terms(rules), "rule int, alternative int, trigram string, bit long, full long")
    met = (postings.join(F.broadcast(asked), "trigram")  # as long as the rules are: fixed size
           .groupBy("doc_id", "text_key", "rule", "alternative").agg(F.bit_or("bit").alias("bits"), F.first("full").alias("full"))
           .filter("bits = full"))
    return met.groupBy("doc_id", "text_key").agg(F.collect_set("rule").alias("rules"))


def _spans(text: Column, k: int, rule: Rule) -> Column:
    """Spans of one rule: the gaps between matches and the matches give every offset."""
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.length(g) >= rule.least)
    steps = F.zip_with(F.zip_with(F.transform(F.slice(gaps, 1, F.size(sizes)), F.length), sizes,
                                  lambda gap, n: F.struct(gap.alias("gap"), n.alias("n"))), kept,
                       lambda s, ok: F.struct(s["gap"].alias("gap"), s["n"].alias("n"), ok.alias("ok")))
    none = F.expr(f"cast(array() as {SPAN})")
    walked = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, s: F.struct(
        (acc["at"] + s["gap"] + s["n"]).alias("at"),
        F.when(s["ok"], F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + s["gap"]).alias("start"), F.lit(k).alias("kind"), (acc["at"] + s["gap"] + s["n"]).alias("stop")))))
        .otherwise(acc["out"]).alias("out")))
    return walked["out"]


def scan(documents: DataFrame, rules=RULES) -> DataFrame:
    """Per row: doc_id, text_key, spans (array of start, kind number, stop; by start, then kind)."""
    return _scanned(documents, rules).select("doc_id", "text_key", "spans")


def _scanned(documents: DataFrame, rules) -> DataFrame:
    asked = terms(rules)
    found = candidates(index(documents, sorted({t[2] for t in asked})), rules).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("rules").alias("__rules"))
    rows = _keyed(documents).join(found.hint("shuffle_hash"), F.expr("doc_id <=> __id and text_key = __key"), "left")
    none = F.expr(f"cast(array() as {SPAN})")
    indexed = {t[0] for t in asked}
    parts = []
    for k, rule in enumerate(rules):
        test = F.array_contains("__rules", k) if k in indexed else \
            F.col("text").rlike(f"{rule.pattern[:-1]}{{{rule.least}}}" if rule.pattern.endswith("]+") and not rule.group else rule.pattern)
        parts.append(F.when(test, _spans(F.col("text"), k, rule)).otherwise(none))
    return rows.withColumn("spans", F.array_sort(F.concat(*parts)))


def joined(spans: Column, rules=RULES) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))


def report(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan(documents)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *(count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(documents: DataFrame, rules=RULES, mask: str = "[secret]") -> DataFrame:
    """The documents with each run of overlapping spans replaced by ``mask``; n_chars follows, where there is one."""
    spans = scan(documents, rules).filter(F.size("spans") > 0).distinct()
    rows = common.keyed(documents).join(spans.hint("shuffle_hash"), F.expr("id <=> doc_id and key = text_key"), "left")
    text = F.col("row.text")
    walked = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, s: F.struct(
        F.greatest(acc["at"], s["stop"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)))
        .otherwise(acc["out"]).alias("out")))
    clean = F.transform(F.array(walked), lambda w: F.concat(w["out"], F.substring(text, w["at"] + 1, F.length(text))))[0]
    out = rows.select("row", F.when(F.col("spans").isNull(), text).otherwise(clean).alias("text"), F.col("spans").isNotNull().alias("changed"))
    new = {"text": F.col("text")}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("changed"), F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))
    return out.select(*(new.get(c, F.col("row")[c]).alias(c) for c in documents.columns))
