"""Quality rules kept as a ledger of failure bits, judged by versioned policies."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import bound, words_of


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` is true; it sees the measurement columns only."""

    name: str
    fails: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


#: A rule's bit is its place here. New rules go to the end, so that stored ledgers keep their meaning.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda: _c("n_words") < 50),
    Rule("repeated_windows", lambda: 100 * _c("n_repeat_words") > 50 * _c("n_words")),
    Rule("symbols", lambda: 10 * _c("n_symbols") > 3 * _c("n_words")),
    Rule("repeated_lines", lambda: 100 * _c("n_dup_lines") > 70 * _c("n_lines")),
    Rule("word_length", lambda: (_c("word_chars") > 20 * _c("n_words")) | (_c("word_chars") < 2 * _c("n_words"))),
    Rule("shouting", lambda: 2 * _c("n_exclaimed") > _c("n_words")),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaimed")


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: a document is kept if none of the named rules failed."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        places = {rule.name: i for i, rule in enumerate(RULES)}
        return sum(1 << places[name] for name in self.rules)


POLICIES = {
    "base": Policy("base", ("few_words", "repeated_windows")),
    "v1": Policy("v1", ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length", "shouting")),
}


def _repeated_positions(hashes: Column) -> Column:
    """Sorted places of the array's values that occur twice or more."""

    def places(s: Column) -> Column:
        same = lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])
        return F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["p"]))

    return bound(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), places)


def _covered(places: Column, width: int) -> Column:
    """Number of places in the union of the windows that start at the given sorted places."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
    return F.aggregate(
        places,
        zero,
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(width), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, row: bool = False) -> DataFrame:
    """One row per input row: the id and the measurements, all of the whole text.

    Words lie between runs of ASCII white space. Windows of ``width`` words are compared by a 64-bit
    hash of their words. A null text counts as an empty one; repeated rows are measured each. With
    ``row`` the whole input row comes along as the struct ``_row``, whatever its columns are called.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    along = ["_row"] if row else []
    given = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")] if row else []
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), *given)
    split = base.select("doc_id", "_text", words_of(F.col("_text")).alias("_words"), *along)
    w, t = F.col("_words"), F.col("_text")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    window = lambda e: F.transform(
        F.sequence(F.lit(0), F.size(e) - width), lambda i: F.xxhash64(*(F.get(e, i + k) for k in range(width)))
    )
    hashes = F.when(F.size(w) >= width, bound(F.transform(w, lambda x: F.xxhash64(x)), window))
    repeats = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(_repeated_positions(h), width))
    long = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size(F.col("_lines")) - F.size(F.array_distinct(F.col("_lines"))),
        "n_repeat_words": F.coalesce(bound(hashes, repeats), F.lit(0)),
        "n_lines": F.size(F.col("_lines")),
        "n_exclaimed": F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit(""))),
    }
    split = split.withColumn("_lines", lines)
    # a generator of one row: a later filter on the measurements stays above it and does not work them out again
    one = F.array(F.struct(*(c.cast("long").alias(name) for name, c in long.items())))
    return split.select("doc_id", *along, F.inline(one))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: bool = False) -> DataFrame:
    """Every rule evaluated once: the measurements and ``failed``, whose bit i is set if RULES[i] failed."""
    bits = [F.when(rule.fails(), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs, id_col, text_col, row=row).withColumn("failed", failed.cast("long"))


def fails(policy: str | Policy, failed: Column | None = None) -> Column:
    """True where the ledger's bits break the policy."""
    p = POLICIES[policy] if isinstance(policy, str) else policy
    return (F.col("failed") if failed is None else failed).bitwiseAND(F.lit(p.mask)) != 0


def judge(rows: DataFrame, policy: str | Policy = "v1") -> DataFrame:
    """The ledger's rows with the base verdict and the policy's."""
    return rows.withColumns({"base_failed": fails("base"), "kept": ~(fails("base") | fails(policy))})


def ablations(rows: DataFrame, policy: str | Policy = "v1") -> DataFrame:
    """Per rule of the policy, from the stored bits alone: rows that fail it, that fail nothing else
    of the policy (so they come back if the rule goes), and that stay without it. One aggregation."""
    p = POLICIES[policy] if isinstance(policy, str) else policy
    place = {rule.name: i for i, rule in enumerate(RULES)}
    held = F.col("failed").bitwiseAND(F.lit(p.mask))
    sums = []
    for name in p.rules:
        bit = 1 << place[name]
        sums += [
            F.count_if(held.bitwiseAND(F.lit(bit)) != 0).alias(f"{name}.failed"),
            F.count_if(held == bit).alias(f"{name}.alone"),
            F.count_if(held.bitwiseAND(F.lit(p.mask & ~bit)) == 0).alias(f"{name}.kept_without"),
        ]
    wide = rows.agg(*sums)
    parts = [
        F.struct(
            F.lit(p.version).alias("policy"),
            F.lit(name).alias("rule"),
            *(F.col(f"`{name}.{k}`").alias(k) for k in ("failed", "alone", "kept_without")),
        )
        for name in p.rules
    ]
    return wide.select(F.inline(F.array(*parts)))


def filter_documents(docs: DataFrame, policy: str | Policy = "v1", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns, that the policy keeps; nothing is joined or shuffled."""
    return judge(ledger(docs, id_col, text_col, row=True), policy).where("kept").select("_row.*")
