"""Secret scans with DataFrame functions only.

Fixed patterns give the base spans. Beyond them, long strings of one character class are candidates:
a window slides over each, the counts of its characters are updated by the one that enters and
the one that leaves, and with them the sum of c*log2(c), from which the Shannon entropy of
the window follows. Windows at or above the class's threshold are joined to spans. Candidates on the
allow list (identifiers and digests that are public by nature) are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import text_of

# The base patterns, with the least length of the match or of its group.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16))


@dataclass(frozen=True)
class EntropyClass:
    """Candidates of ``pattern`` that also match all of ``mixed``; windows of ``window`` characters of ``alphabet`` count from ``bits`` on."""

    kind: str
    pattern: str
    alphabet: str
    mixed: tuple[str, ...]
    window: int
    bits: float


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# A value ends at a separator that is no part of its alphabet; names before "=" are not part of it, padding after it is.
_VALUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
_VALUE_CHARS = _UPPER + _LOWER + _DIGITS + "+/_=-"
CLASSES = (
    EntropyClass("entropy_hex", r"(?<![A-Za-z0-9])(?:[0-9a-f]{20,}|[0-9A-F]{20,})(?![A-Za-z0-9])", _DIGITS + "abcdefABCDEF", ("[0-9]", "[A-Fa-f]"), 20, 3.0),
    EntropyClass("entropy_base64", _VALUE, _VALUE_CHARS, ("[0-9]", "[A-Z]", "[a-z]"), 20, 3.7),
    EntropyClass("entropy_lower", _VALUE, _VALUE_CHARS, ("[0-9]", "[g-z]", "^[^A-Z]+$"), 20, 3.7),
    EntropyClass("entropy_upper", _VALUE, _VALUE_CHARS, ("[0-9]", "[G-Z]", "^[^a-z]+$"), 20, 3.7),
)
#: Whole candidates that are no secrets: UUIDs, version-control and content digests after their scheme, placeholders, counting sequences.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"^(?:sha1|sha256|sha384|sha512|md5)[-=]",
    r"^(?i:[a-z]*[-_]?(?:example|sample|placeholder|dummy)(?:[-_]?[a-z]+)*[-_]?[0-9]*)$",
    r"^(?:0123456789(?:abcdef|ABCDEF)|(?i:abcdefghijklmnopqrstuvwxyz)|0123456789)+$",
)
_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _placed(pieces: Column, matches: Column, values: Column) -> Column:
    """(start, end, value) of each match in code points, from the texts between the matches."""
    steps = F.arrays_zip(pieces.alias("piece"), matches.alias("match"), values.alias("value"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,value:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        found = F.array(F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), x["value"].alias("value")))
        return F.struct(end.cast("long").alias("at"), F.when(x["match"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], found)).alias("out"))

    return F.aggregate(steps, zero, step)["out"]


def _matches(df: DataFrame, name: str, pattern: str, group: int) -> DataFrame:
    """Adds ``name``: (start, end, value) of the leftmost non-overlapping matches of ``pattern`` in ``text``."""
    hit, none = F.col("text").rlike(pattern), F.array().cast("array<string>")
    columns = {
        "_pieces": F.when(hit, F.split("text", pattern, -1)).otherwise(none),
        "_matches": F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none),
    }
    if group:
        columns["_values"] = F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).otherwise(none)
    df = df.withColumns(columns)
    placed = _placed(F.col("_pieces"), F.col("_matches"), F.col("_values" if group else "_matches"))
    return df.withColumn(name, placed).drop(*columns)


def _hot_spans(value: Column, offset: Column, kind: int, c: EntropyClass) -> Column:
    """Spans of ``value`` whose windows have at least ``c.bits`` of entropy, moved by ``offset``."""
    w, size = c.window, len(c.alphabet)
    weight = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(w + 2)])
    chars = F.filter(F.split(value, ""), lambda x: x != "")
    places = F.transform(chars, lambda x: F.instr(F.lit(c.alphabet), x) - 1)
    steps = F.transform(places, lambda x, i: F.struct(x.alias("new"), F.when(i >= w, F.get(places, i - w)).otherwise(F.lit(-1)).alias("old"), i.alias("i")))
    zero = F.struct(
        F.array_repeat(F.lit(0), size).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(-1).cast("long").alias("start"),
        F.lit(-1).cast("long").alias("end"),
        F.array().cast(_SPANS).alias("out"),
    )

    def span(start: Column, end: Column) -> Column:
        return F.array(F.struct((offset + start).cast("long").alias("start"), F.lit(kind).alias("kind"), (offset + end).cast("long").alias("end")))

    def step(acc: Column, x: Column) -> Column:
        entering, leaving = F.get(acc["counts"], x["new"]), F.get(acc["counts"], x["old"])
        gained = F.get(weight, entering + 1) - F.get(weight, entering)
        lost = F.when(x["old"] >= 0, F.get(weight, leaving) - F.get(weight, leaving - 1)).otherwise(0.0)
        same = x["new"] == x["old"]
        total = F.when(same, acc["sum"]).otherwise(acc["sum"] + gained - lost)
        counts = F.transform(acc["counts"], lambda n, k: n + F.when(k == x["new"], 1).otherwise(0) - F.when(k == x["old"], 1).otherwise(0))
        hot = (x["i"] >= w - 1) & (F.lit(math.log2(w)) - total / w >= c.bits - 1e-9)
        first, last = (x["i"] - (w - 1)).cast("long"), (x["i"] + 1).cast("long")
        apart = hot & (first > acc["end"])
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(apart, first).otherwise(acc["start"]).alias("start"),
            F.when(hot, last).otherwise(acc["end"]).alias("end"),
            F.when(apart & (acc["start"] >= 0), F.concat(acc["out"], span(acc["start"], acc["end"]))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(steps, zero, step, lambda acc: F.when(acc["start"] >= 0, F.concat(acc["out"], span(acc["start"], acc["end"]))).otherwise(acc["out"]))


def _kept(matches: Column, kind: int, least: int) -> Column:
    """Spans of the matches whose value has at least ``least`` characters."""
    kept = F.filter(matches, lambda m: F.length(m["value"]) >= least)
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def _entropy_spans(matches: Column, kind: int, c: EntropyClass, allowed: tuple[str, ...]) -> Column:
    """Spans of high entropy in the candidates that have the class's mixture and are not allowed."""

    def candidate(m: Column) -> Column:
        fits = F.lit(True)
        for pattern in c.mixed:
            fits = fits & m["value"].rlike(pattern)
        for pattern in allowed:
            fits = fits & ~m["value"].rlike(pattern)
        return fits

    return F.flatten(F.transform(F.filter(matches, candidate), lambda m: _hot_spans(m["value"], m["start"], kind, c)))


def _joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: tuple[EntropyClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row for each row of ``docs``: doc_id, base and spans as arrays of (start, kind, end), and n_<kind> of the base kinds.

    Positions count code points, ends are exclusive, and ``kind`` is a place in ``kinds(classes)``. A base
    match is a whole match of its pattern, taken from the left without overlaps; matches
    that are too short are dropped afterwards. Null and empty texts have no spans; repeated
    rows are rows of their own; an empty table gives no rows; other columns are not read.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    base = F.array().cast(_SPANS)
    counts = []
    for k, (kind, pattern, group, least) in enumerate(BASE):
        df = _matches(df, f"_{kind}", pattern if kind != "hex" else f"[0-9a-f]{{{least},}}", group)
        df = df.withColumn(f"_{kind}", _kept(F.col(f"_{kind}"), k, least))
        base = F.concat(base, F.col(f"_{kind}"))
        counts.append(F.size(f"_{kind}").cast("long").alias(f"n_{kind}"))
    spans = base
    for k, c in enumerate(classes, len(BASE)):
        df = _matches(df, f"_{c.kind}", c.pattern, 0)

        found = _entropy_spans(F.col(f"_{c.kind}"), k, c, allowed)
        df = df.withColumn(f"_{c.kind}", found)
        spans = F.concat(spans, F.col(f"_{c.kind}"))
    return df.select("doc_id", base.alias("base"), spans.alias("spans"), *counts)


def kinds(classes: tuple[EntropyClass, ...] = CLASSES) -> tuple[str, ...]:
    return (*[b[0] for b in BASE], *[c.kind for c in classes])


def secret_digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans as text."""
    names = kinds(options.get("classes", CLASSES))
    found = secret_spans(docs, **options)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_joined(F.col("base"), names), 256).alias("base_sha256"), _joined(F.col("spans"), names).alias("spans"))
