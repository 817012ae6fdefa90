"""Quality rules as a ledger: every rule is evaluated once per document, its failure is one bit of a mask.

Policies are masks over the ledger, so a new policy or an ablation reads the bits and never the text again. All work is
done in column expressions of one row each: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import SPACES, text_or_empty, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule fails where `fails`, an SQL condition over the measurements, is true. Its place in RULES is its bit."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("shouting", "2 * n_upper > n_letters"),
    Rule("few_letters", "2 * n_letters < word_chars"),
)

# Version of a policy -> rules whose failure rejects a document.
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "full-1": tuple(rule.name for rule in RULES),
}
CURRENT = "full-1"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")


def mask(version: str) -> int:
    names = POLICIES[version]
    return sum(1 << bit for bit, rule in enumerate(RULES) if rule.name in names)


def _characters(text: Column, pattern: str) -> Column:
    """Code points of the text that match a character class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc`, a struct of all its columns, and the measurements as longs.

    A null text counts as empty; an empty one measures 0 everywhere. Repeated rows are measured each on its own. Extra
    columns stay inside `doc` whatever they are called. Repeated windows are told apart by a 64-bit hash of their words.
    """
    kept = docs.select(F.struct("*").alias("doc"), text_or_empty(text).alias("t"))
    split = kept.select("doc", "t", words(F.col("t")).alias("w"), F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("w")
    triples = F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, n).alias("b"), F.slice("w", 3, n).alias("c"))
    hashed = split.select(
        "doc",
        n.cast("long").alias("n_words"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _characters(F.col("t"), r"\p{L}+").cast("long").alias("n_letters"),
        _characters(F.col("t"), r"\p{Lu}+").cast("long").alias("n_upper"),
        F.when(n >= 3, F.transform(F.slice(triples, 1, n - 2), lambda x: F.xxhash64(x["a"], x["b"], x["c"]))).alias("h"),
    )
    # Most documents repeat no window: only the others are sorted.
    again = F.size(F.array_distinct("h")) < F.size("h")
    placed = F.arrays_zip(F.col("h").alias("h"), F.sequence(F.lit(0), F.size("h") - 1).alias("i"))
    ordered = hashed.withColumn("s", F.when(again, F.array_sort(placed))).drop("h")
    equal = lambda x, k: F.coalesce(x["h"] == F.get("s", k)["h"], F.lit(False))
    repeated = F.filter("s", lambda x, k: equal(x, k - 1) | equal(x, k + 1))
    twice = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    starts = ordered.withColumn("p", twice).drop("s")
    # Each window covers three words; one that starts closer than that to the one before adds the difference.
    covered = F.aggregate(
        "p",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).select("doc", *MEASURES)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The measurements and `failures`, a long with one bit for each failed rule."""
    bits = [F.when(F.expr(rule.fails), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, rule in enumerate(RULES)]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    # Generated rows keep filters above them: pushed below, a filter on the bits would evaluate the measures many times.
    row = F.struct("doc", *MEASURES, failures.cast("long").alias("failures"))
    return measured(docs, text).select(F.explode(F.array(row)).alias("row")).select("row.*")


def rejected(version: str = CURRENT) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask(version)).cast("long")) != 0


def applied(docs: DataFrame, version: str = CURRENT, text: str = "text") -> DataFrame:
    """The documents that pass a policy, with their own columns."""
    return ledger(docs, text).filter(~rejected(version)).select("doc.*")


def ablations(ledger_rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents it fails, and those that only it rejects. One pass over the bits.

    An empty ledger gives one row per rule with zeros.
    """
    rules = [(1 << bit, rule.name) for bit, rule in enumerate(RULES) if rule.name in POLICIES[version]]
    hit = F.col("failures").bitwiseAND(F.lit(mask(version)).cast("long"))
    sums = [F.coalesce(F.sum(F.when(hit.bitwiseAND(F.lit(b).cast("long")) != 0, 1)), F.lit(0)).alias(f"f{b}") for b, _ in rules]
    sums += [F.coalesce(F.sum(F.when(hit == b, 1)), F.lit(0)).alias(f"o{b}") for b, _ in rules]
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"f{b}").cast("long").alias("failed"), F.col(f"o{b}").cast("long").alias("only_here")) for b, name in rules]))
    return ledger_rows.agg(*sums).select(rows.alias("r")).select("r.*")
