"""Helpers of the corpus operators: text columns and offsets of matches."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A run of ASCII white space; what is between such runs is a word.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words_of(c: Column) -> Column:
    """Words between runs of ASCII white space; an empty text has none."""
    return F.array_remove(F.split(c, BLANK), "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use`` refers to it in a lambda."""
    return F.get(F.transform(F.array(value), use), 0)


SPAN = "struct<start:int,end:int,value:string>"

#: Offsets are summed in blocks of this many matches, so that no accumulator grows with the text.
BLOCK = 128


def match_spans(text: Column, pattern: str | Column) -> Column:
    """Array of (start, end, value) for all matches, leftmost first, in code points, end exclusive.

    Splitting by the pattern gives the gaps, extracting it gives the matches, in the same order; the
    offsets are running sums of both. The pattern must not match the empty string. Null text: null.
    """
    empty = F.array().cast(f"array<{SPAN}>")
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))

    def step(acc, pair):
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["value"])
        one = F.struct(begin.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    def block(acc, pairs):
        inner = F.aggregate(pairs, F.struct(acc["at"].alias("at"), empty.alias("spans")), step)
        return bound(
            inner, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["parts"], F.array(x["spans"])).alias("parts"))
        )

    def blocks(pairs):
        ends = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int"))
        cut = F.transform(ends, lambda b: F.slice(pairs, b * BLOCK + 1, F.lit(BLOCK)))
        none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("parts"))
        return F.flatten(F.aggregate(cut, none, block, lambda acc: acc["parts"]))

    pairs = F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    pairs = F.filter(pairs, lambda x: x["value"].isNotNull())
    return F.when(F.regexp_like(text, pattern), bound(pairs, blocks)).when(text.isNotNull(), empty)


def process_cache(name: str) -> dict:
    """A dict that lives as long as the process; task functions are shipped by value, so their globals do not."""
    held = sys.modules.setdefault("_curvelake_process_cache", types.ModuleType("_curvelake_process_cache"))
    return held.__dict__.setdefault(name, {})
