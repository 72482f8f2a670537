"""Line deduplication by a join of deletion neighbourhoods.

Two lines are near if at most one word was replaced, inserted or deleted (edit distance in words of at
most 1). A line goes if an earlier line, in the order of document and place, is equal or near to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import BLANK, WORD, bound, words_of
from curvelake.session import materialize

#: Up to so many rows (some 30 MB) a list of lines is broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 500_000


#: A place is one number, (document * HASHED + bits of the text's hash) * LINES + line: its minimum is the earliest, and
#: it fits a hash aggregate's buffer. No text has more lines.
PLACE, HASHED, LINES = "decimal(38,0)", 1 << 30, 1 << 31


def _key(id_col: Column, text: Column) -> Column:
    """Document part of a place. Null ids come first; such rows are told apart by 93 bits of two hashes of the text, rows that share an id by 30."""
    without = F.lit("-9223372036854775809").cast(PLACE) - F.shiftrightunsigned(F.xxhash64(F.lit(1), text), 1).cast(PLACE)
    d = F.coalesce(id_col.cast("long").cast(PLACE), without.cast(PLACE))
    return (d * F.lit(HASHED) + F.pmod(F.xxhash64(text), F.lit(HASHED))).cast(PLACE)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(_key(F.col(id_col), text).alias("key"), text.alias("text"))


def _enough(min_words: int) -> str:
    """Matches a line of at least so many words."""
    return rf"^{BLANK[:-1]}*+(?:{WORD}+{BLANK}+){{{min_words - 1}}}{WORD}" if min_words > 0 else "^"


def _small(side: DataFrame) -> DataFrame:
    """Written once; broadcast if it has at most BROADCAST_ROWS rows, else left to a shuffle join."""
    side = materialize(side)
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def _place() -> Column:
    return (F.col("key") * F.lit(LINES) + F.col("l")).cast(PLACE)


def _split(keyed: DataFrame) -> DataFrame:
    return keyed.select("key", F.posexplode(F.split("text", "\n")).alias("l", "line"))


def _lines(keyed: DataFrame, min_words: int) -> DataFrame:
    """The lines that take part: place and words."""
    return _split(keyed).where(F.col("line").rlike(_enough(min_words))).select(_place().alias("place"), words_of(F.col("line")).alias("w"))


def _half_keys(w: Column) -> list[Column]:
    """Four keys of which two near lines share at least one.

    If n is the length of the shorter line, one edit leaves its first n // 2 words or its last n - n // 2 words
    untouched, and the other line starts or ends with them. A line takes part as the shorter (its own
    length) and as the longer (one less).
    """
    keys = []
    for n in (F.size(w), F.size(w) - 1):
        head = F.floor(n / 2).cast("int")
        keys.append(F.xxhash64(n, F.lit(0), F.slice(w, F.lit(1), head)))
        keys.append(F.xxhash64(n, F.lit(1), F.slice(w, F.size(w) - (n - head) + 1, n - head)))
    return keys


def _distinct_lines(keyed: DataFrame, min_words: int) -> DataFrame:
    """One row per different line with its earliest place and its half keys.

    Lines are told apart by two independent 64-bit hashes. Equal lines meet as partial minima, so a line that fills
    a third of the corpus costs no more than any other.
    """
    w = F.col("w")
    halves = [k.alias(f"half{i}") for i, k in enumerate(_half_keys(w))]
    hashed = _lines(keyed, min_words).select("place", F.xxhash64(w).alias("h1"), F.xxhash64(F.lit(1), w).alias("h2"), *halves)
    least = [F.min(c).alias(c) for c in ("place", "half0", "half1", "half2", "half3")]
    return hashed.groupBy("h1", "h2").agg(*least)


def _near_candidates(keyed: DataFrame, lines: DataFrame) -> DataFrame:
    """Different lines that share half of their words with another one, with their words: only these are cut into words."""
    halves = lines.select("place", F.explode(F.array("half0", "half1", "half2", "half3")).alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    places = _small(halves.join(_small(shared), "half", "left_semi").select("place").distinct())
    met = _split(keyed).select(_place().alias("place"), "line").join(places, "place", "left_semi").dropDuplicates(["place"])
    return materialize(met.select("place", words_of(F.col("line")).alias("w")))


def _replaced(lines: DataFrame) -> DataFrame:
    """Places of lines with an earlier line that differs in one word.

    A variant is the line without its i-th word, under a hash of the places and words left. Lines with an equal
    variant are all near to each other, so each is compared with the earliest alone; no pairs are listed.
    """
    h = F.transform("w", lambda v, i: F.xxhash64(i, v))
    whole = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))
    each = bound(h, lambda a: bound(whole(a), lambda x: F.transform(a, lambda y: x.bitwiseXOR(y))))
    variants = lines.select("place", F.size("w").alias("n"), F.posexplode(each).alias("i", "rest"))
    first = variants.groupBy("n", "i", "rest").agg(F.min("place").alias("earliest"), F.count("*").alias("c"))
    pairs = variants.join(_small(first.where("c > 1")), ["n", "i", "rest"]).where(F.col("place") != F.col("earliest"))
    a, b = lines.select("place", F.col("w").alias("a")), lines.select(F.col("place").alias("earliest"), F.col("w").alias("b"))
    left = lambda w: F.concat(F.slice(w, F.lit(1), F.col("i")), F.slice(w, F.col("i") + 2, F.size(w)))
    found = pairs.select("place", "earliest", "i").join(a, "place").join(b, "earliest")
    return found.where((F.size("a") == F.size("b")) & (left(F.col("a")) == left(F.col("b")))).select("place")


def _inserted(lines: DataFrame) -> DataFrame:
    """Places of lines with an earlier line that has one word more or less.

    The variants of the longer line meet the whole shorter one under a hash of the pairs of neighbouring
    words. A whole line is there once, so the join has a row per variant at most; equal hashes are verified.
    """
    pair = lambda a, b: F.xxhash64(F.coalesce(a, F.lit("\n")), F.coalesce(b, F.lit("\n")))
    at = lambda w, i: F.when(i >= 0, F.get(w, i))

    def total(w: Column) -> Column:
        sums = F.transform(w, lambda v, i: pair(at(w, i - 1), v))
        return F.aggregate(sums, pair(F.get(w, F.size(w) - 1), F.lit(None).cast("string")), lambda x, y: x.bitwiseXOR(y))

    def without(w: Column, x: Column) -> Column:
        change = lambda v, i: x.bitwiseXOR(pair(at(w, i - 1), v)).bitwiseXOR(pair(v, F.get(w, i + 1))).bitwiseXOR(
            pair(at(w, i - 1), F.get(w, i + 1))
        )
        return F.transform(w, change)

    hashed = lines.select("place", F.size("w").alias("n"), "w", total(F.col("w")).alias("x"))
    short = _small(hashed.select(F.col("place").alias("short"), "n", F.col("x").alias("rest")))
    long = hashed.select(
        F.col("place").alias("long"), (F.col("n") - 1).alias("n"), F.posexplode(without(F.col("w"), F.col("x"))).alias("j", "rest")
    )
    words = lambda place, w: lines.select(F.col("place").alias(place), F.col("w").alias(w))
    met = long.join(short, ["n", "rest"]).join(words("short", "a"), "short").join(words("long", "b"), "long")
    rest = F.concat(F.slice("b", F.lit(1), F.col("j")), F.slice("b", F.col("j") + 2, F.size("b")))
    return met.where(F.col("a") == rest).select(F.greatest("short", "long").alias("place"))


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5) -> DataFrame:
    """Per document ``key`` the numbers of the lines of ``min_words`` words or more that stay."""
    keyed = _documents(docs, id_col, text_col)
    lines = materialize(_distinct_lines(keyed, min_words))
    near = _near_candidates(keyed, lines)
    gone = _replaced(near).unionByName(_inserted(near)).distinct()
    stay = lines.select("place").join(gone, "place", "left_anti")
    l = F.pmod(F.col("place"), F.lit(LINES).cast(PLACE))  # noqa: E741
    parts = stay.select(((F.col("place") - l) / F.lit(LINES)).cast(PLACE).alias("key"), l.cast("int").alias("l"))
    return parts.groupBy("key").agg(F.collect_list("l").alias("stay"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5) -> DataFrame:
    """The input rows with ``text`` cut to its kept lines, in order, plus ``_lines``, ``_kept`` and ``_changed``.

    Lines are what newlines separate; words lie between runs of ASCII white space, and white space is
    no difference. Lines under ``min_words`` words always stay. The earliest line, by id, then
    place in the text, stays; ids are whole numbers. Null texts come back null; repeated rows (same id and text) count as
    one and come back alike; null ids come first. Of n different texts under one id some n^2 / 2^31 pairs count as one document. Texts of any
    length are cut whole; an empty table gives no rows. Other columns pass untouched, but given ones with the three added names are replaced.
    """
    stay = kept_lines(docs, id_col, text_col, min_words)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), _key(F.col(id_col), text).alias("key"))
    met = rows.join(stay, "key", "left")
    cut = F.split(F.col(f"_row.`{text_col}`"), "\n")
    lines = met.select("_row", cut.alias("_cut"), F.coalesce("stay", F.array().cast("array<int>")).alias("_stay"))
    short = F.filter(
        F.transform(F.col("_cut"), lambda v, i: F.when(~v.rlike(_enough(min_words)), i)), lambda i: i.isNotNull()
    )
    chosen = lines.select("_row", "_cut", F.sort_array(F.concat("_stay", short)).alias("_places"))
    text = bound(F.col("_cut"), lambda cut: F.array_join(F.transform(F.col("_places"), lambda i: F.get(cut, i)), "\n"))
    out = [text.alias(c) if c == text_col else F.col(f"_row.`{c}`") for c in docs.columns if c not in ("_lines", "_kept", "_changed")]
    return chosen.select(*out, F.size("_cut").alias("_lines"), F.size("_places").alias("_kept"), (F.size("_places") < F.size("_cut")).alias("_changed"))
