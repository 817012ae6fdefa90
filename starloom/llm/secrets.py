"""Secret scan: known shapes by pattern, unknown ones by the entropy of a sliding window. Column expressions only.

Every text is scanned whole, inside its row: no shuffle, no Python. Positions are code points, the end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_or_empty

# Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
# Character class of a candidate -> bits a character that a window must reach.
LIMITS = {"hex": 3.0, "mixed": 3.7}
# Strings that look random and are no secrets: UUIDs, integrity hashes, worked examples. STRETCHES is how far each goes
# in a text: what stands beside it in the same candidate is looked at by itself.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^sha(1|256|384|512)-",
    r"(?i)example",
    r"(?i)abcdefghij|0123456789",
)
SIDE = r"[A-Za-z0-9+/_=-]"
STRETCHES = (
    rf"(?<!{SIDE})[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}(?!{SIDE})",
    rf"(?<!{SIDE})sha(?:1-[A-Za-z0-9+/_-]{{0,27}}|256-[A-Za-z0-9+/_-]{{0,43}}|384-[A-Za-z0-9+/_-]{{0,64}}|512-[A-Za-z0-9+/_-]{{0,86}})={{0,2}}",
    r"(?i:example)",
    r"(?i:abcdefghij)|0123456789",
)
SCALE = 1 << 20
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: str, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """All matches of a pattern with their places: what stands between matches gives the offsets."""
    found, gaps = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)), F.split(text, pattern)
    state = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(
            F.coalesce(end, acc["at"]).alias("at"),
            F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"),
        )

    hits = F.arrays_zip(found.alias("hit"), gaps.alias("gap"))
    return F.when(F.col(text).rlike(pattern), F.aggregate(hits, state, step, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def _cost(count: Column) -> Column:
    """count * log2(count) in whole units, so that sums kept by adding and taking away stay exact."""
    table = [0] + [round(c * math.log2(c) * SCALE) for c in range(1, WINDOW + 1)]
    return F.get(F.array(*[F.lit(v).cast("long") for v in table]), count)


def _rich_range(candidate: Column) -> Column:
    """From the first to the end of the last window that is rich enough, counted in the candidate; null if none is.

    Counts per character are kept while the window slides: each step adds the character that comes in, takes away the
    one that leaves, and changes the sum by these two alone.
    """
    symbols = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    symbols = F.filter(symbols, lambda s: s >= 0)
    limit = F.when(candidate.rlike(r"^([0-9a-f]+|[0-9A-F]+)$"), F.lit(LIMITS["hex"])).otherwise(F.lit(LIMITS["mixed"]))
    # Bits a character are log2(WINDOW) - cost / WINDOW: at least the limit where the cost is at most this.
    most = F.floor((F.lit(math.log2(WINDOW)) - limit) * WINDOW * SCALE)
    zero = F.array_repeat(F.lit(0), len(ALPHABET))
    state = F.struct(
        zero.alias("n"), F.lit(0).cast("long").alias("cost"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last")
    )
    steps = F.arrays_zip(symbols.alias("new"), F.concat(F.array_repeat(F.lit(None).cast("int"), WINDOW), symbols).alias("old"))

    def step(acc, x):
        after = F.transform(acc["n"], lambda c, k: c - F.when(k == x["old"], 1).otherwise(0) + F.when(k == x["new"], 1).otherwise(0))
        gone, come = F.coalesce(F.get(acc["n"], x["old"]), F.lit(0)), F.get(acc["n"], x["new"])
        apart = F.coalesce(x["old"] != x["new"], F.lit(True))
        change = F.when(apart, _cost(come + 1) - _cost(come) + F.when(gone > 0, _cost(gone - 1) - _cost(gone)).otherwise(0)).otherwise(0)
        i = acc["i"] + 1
        cost = acc["cost"] + change
        rich = (i >= WINDOW) & (cost <= most)
        return F.struct(
            F.when(apart, after).otherwise(acc["n"]).alias("n"),
            cost.alias("cost"),
            i.alias("i"),
            F.when(acc["first"].isNull() & rich, i - WINDOW).otherwise(acc["first"]).alias("first"),
            F.when(rich, i).otherwise(acc["last"]).alias("last"),
        )

    whole = F.slice(steps, 1, F.length(candidate))
    return F.aggregate(whole, state, step, lambda acc: F.when(acc["last"].isNotNull(), F.struct(acc["first"].alias("first"), acc["last"].alias("last"))))


def _suspect(candidate: Column) -> Column:
    """Worth a closer look: digits and letters both."""
    return candidate.rlike(r"[0-9]") & candidate.rlike(r"[A-Za-z]")


def _blanked(text: str, spans: Column) -> Column:
    """The text with blanks for what the spans hold, place by place; spans in the order of their starts."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        gap = F.substring(F.col(text), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(gap, blank)).alias("out"))

    def finish(acc):
        return F.concat(F.array_join(acc["out"], ""), F.substring(F.col(text), acc["at"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, F.col(text)).otherwise(F.aggregate(spans, state, step, finish))


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc`, a struct of all its columns, `base` and `spans`, arrays of (start, kind, end).

    `kind` is a place in KINDS. `base` holds the pattern kinds, leftmost and not overlapping within a kind; `spans` has
    these and, outside of them, ranges of candidate strings whose windows are rich in entropy. Where a pattern kind or a
    stretch of the allow list takes a part of a candidate, the rest of it is looked at. Null and empty texts have empty arrays, repeated rows are scanned each on its own, extra columns stay inside `doc`.
    """
    kept = docs.select(F.struct("*").alias("doc"), text_or_empty(text).alias("t"))
    values = F.regexp_extract_all(F.col("t"), F.lit(ASSIGN), F.lit(2))
    found = kept.select(
        "doc",
        "t",
        _spans("t", ASSIGN, 0).alias("assign"),
        F.when(F.col("t").rlike(ASSIGN), values).alias("values"),
        _spans("t", ACCESS, 1).alias("access"),
        _spans("t", HEX, 2).alias("hex"),
        _spans("t", "|".join(STRETCHES), 3).alias("allowed"),
    )
    long_enough = F.filter("assign", lambda s, i: F.length(F.get("values", i)) >= 8)
    based = found.select("doc", "t", F.array_sort(F.concat(long_enough, "access", "hex")).alias("base"), "allowed")
    rest = based.select("doc", "t", "base", _blanked("t", F.array_sort(F.concat("base", "allowed"))).alias("rest"))
    pieces = rest.select("doc", "t", "base", "rest", _spans("rest", CANDIDATE, 3).alias("pieces"))

    def closer(span):
        candidate = F.substring(F.col("rest"), span["start"] + 1, span["end"] - span["start"])
        rich = F.when(_suspect(candidate), _rich_range(candidate))
        return F.struct((span["start"] + rich["first"]).alias("start"), F.lit(3).alias("kind"), (span["start"] + rich["last"]).alias("end"))

    looked = F.transform("pieces", closer)
    rich = F.filter(looked, lambda s: s["start"].isNotNull())
    return pieces.select("doc", "t", "base", F.array_sort(F.concat("base", rich)).alias("spans"))


def counted(spans: str, kind: str) -> Column:
    """How many of the spans are of a kind."""
    # One parameter only: a second one of the function would be given the place of the span.
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def listed(spans: str) -> Column:
    """Spans as text, kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def redacted(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by a mark; overlapping spans become one. A text without spans stays as is."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        gap = F.substring(F.col("t"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        parts = F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(gap, F.lit(mark))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("out"))

    def finish(acc):
        return F.concat(F.array_join(acc["out"], ""), F.substring(F.col("t"), acc["at"] + 1, F.length("t")))

    clean = F.when(F.size("spans") == 0, F.col(f"doc.{text}")).otherwise(F.aggregate("spans", state, step, finish))
    return scanned(docs, text).withColumn("clean", clean).select(*[F.col("clean").alias(n) if n == text else F.col("doc").getField(n).alias(n) for n in docs.columns])
