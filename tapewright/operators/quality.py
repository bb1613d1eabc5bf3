"""Conformance of JSON records to the declared trade and quote shapes."""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from tapewright.functions.text import END, end_mark, wrapped
from tapewright.functions.times import MAX_EVENT_MS, MIN_EVENT_MS
from tapewright.operators.rows import reason_list


@dataclass(frozen=True)
class Rule:
    """What one required member must satisfy."""

    name: str
    kind: str  # string, number or integer
    min_length: int | None = None
    one_of: tuple = ()
    above: float | None = None
    at_least: float | None = None


# The declared record shapes. Every member is required, no other member is allowed.
TRADE_RULES = (
    Rule("trade_id", "string"),
    Rule("symbol", "string", min_length=3),
    Rule("price", "number", above=0),
    Rule("quantity", "number", above=0),
    Rule("side", "string", one_of=("buy", "sell")),
    Rule("event_time", "integer", at_least=0),
)
QUOTE_RULES = (
    Rule("symbol", "string", min_length=3),
    Rule("bid_price", "number", above=0),
    Rule("bid_size", "number", above=0),
    Rule("ask_price", "number", above=0),
    Rule("ask_size", "number", above=0),
    Rule("event_time", "integer", at_least=0),
)
# End of fixed values.


def _readings(rule):
    """JSON kind, text and number of one member, each only if some rule needs it.

    They become plain columns: fields of a struct would be copied into every later use.
    """
    member = F.try_variant_get("_v", f"$[0].{rule.name}", "variant")
    readings = [F.schema_of_variant(member).alias(f"_kind_{rule.name}")]
    if rule.kind != "number":
        readings.append(F.try_variant_get("_v", f"$[0].{rule.name}", "string").alias(f"_text_{rule.name}"))
    if rule.kind != "string":
        readings.append(F.try_variant_get("_v", f"$[0].{rule.name}", "double").alias(f"_number_{rule.name}"))
    return readings


def _reason(rule):
    """Why one member does not conform, NULL when it does. The reasons of a member exclude each other."""
    kind, as_text, as_number = (F.col(f"_{part}_{rule.name}") for part in ("kind", "text", "number"))
    if rule.kind == "string":
        fits = kind == "STRING"
    else:
        fits = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    if rule.kind == "integer":
        # 1, 1.0 and 1e2 are integers, 1.5 is not; the JSON type alone does not tell. A decimal is
        # printed without trailing zeros, so a point in it means a fraction.
        whole = F.when(kind.startswith("DECIMAL"), ~as_text.contains(".")).otherwise(as_number == F.floor(as_number))
        fits = fits & whole
    reason = F.when(kind.isNull(), f"{rule.name}:required").when(~fits, f"{rule.name}:type")
    if rule.min_length is not None:
        reason = reason.when(F.length(as_text) < rule.min_length, f"{rule.name}:length")
    if rule.one_of:
        reason = reason.when(~as_text.isin(*rule.one_of), f"{rule.name}:enum")
    if rule.above is not None:
        reason = reason.when(~(as_number > rule.above), f"{rule.name}:range")
    if rule.at_least is not None:
        reason = reason.when(~(as_number >= rule.at_least), f"{rule.name}:range")
    return reason


def violations(records, rules=TRADE_RULES, value="value"):
    """Adds ``violations``, the reasons a JSON record does not conform, by member name; empty if it does."""
    raw = F.col(value)
    parsed = records.withColumn("_v", F.try_parse_json(wrapped(raw)))
    closed = F.try_variant_get("_v", f"$[1].{END}", "string") == end_mark(raw)
    sole = F.coalesce(closed & F.try_variant_get("_v", "$[2]", "variant").isNull(), F.lit(False))
    read = parsed.select(
        *records.columns,
        (~sole).alias("_bad"),
        F.size(F.try_variant_get("_v", "$[0]", "map<string,variant>")).alias("_members"),
        *[reading for r in rules for reading in _readings(r)],
    )
    # Duplicate names do not parse, so a member beyond the known ones present is an extra one.
    present = sum((F.when(F.col(f"_kind_{r.name}").isNotNull(), 1).otherwise(0) for r in rules), F.lit(0))
    reasons = {r.name: _reason(r) for r in rules}
    reasons["record"] = F.when(F.col("_members") > present, "record:extra")
    joined = F.when(F.col("_bad"), "record:object").otherwise(F.concat_ws(",", *[reasons[n] for n in sorted(reasons)]))
    return read.select(*records.columns, joined.alias("_joined")).select(
        *records.columns, reason_list(F.col("_joined")).alias("violations")
    )


def split_records(records, rules=TRADE_RULES, value="value"):
    """All records with ``violations`` and ``outcome``, valid or rejected, from one scan and one parse.

    Whoever stores both kinds partitions by ``outcome`` or caches the frame; two filters would parse twice.
    """
    checked = violations(records, rules, value)
    return checked.withColumn("outcome", F.when(F.size("violations") == 0, "valid").otherwise("rejected"))


def violation_counts(checked):
    """How often each reason occurs. Only the reason is shuffled, already counted per task."""
    # Exploding a plain column would add a filter on it, with the parse copied into that.
    return (
        checked.select(F.explode(F.array_distinct("violations")).alias("violation"))
        .groupBy("violation")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def split_complete(rows, required, times=()):
    """Rows fit for a keyed table, and the others with reasons: no NULL in ``required``, and ``times`` that a timestamp can hold."""
    wrong = [F.when(F.col(c).isNull(), f"{c}:null") for c in required]
    wrong += [F.when(~F.col(c).between(MIN_EVENT_MS, MAX_EVENT_MS), f"{c}:range") for c in times]
    # Not dropna, which takes NaN for NULL.
    complete = reduce(and_, [F.col(c).isNotNull() for c in required])
    for c in times:
        complete = complete & F.coalesce(F.col(c).between(MIN_EVENT_MS, MAX_EVENT_MS), F.lit(False))
    return rows.where(complete), rows.where(~complete).withColumn("violations", reason_list(F.concat_ws(",", *wrong)))
