"""Personal data: exact spans of protected entities, and terms that the corpus shows to disclose them.

An entity is the value of an email, ip, card or phone span. With P from document counts, a term's disclosure of
an entity is PMI(term; entity) / IC(entity), where IC(entity) = -log P(entity). It is 1 for a term that occurs
only near the entity and at most 0 for one that says nothing. Terms from ``generalise`` on are replaced by a
class, from ``remove`` on they are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import match_spans
from curvelake.llm.secrets import redacted
from curvelake.operators.joins import fresh
from curvelake.session import materialize

# A match may begin where the last one ended or where a run of its first characters begins: no other place can be
# leftmost, so long runs cost linear time. Possessive repetition changes no match, as what follows lies outside the class.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"\p{L}[\p{L}\p{N}_'-]++"

OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"

#: Characters on either side of an entity in which a term counts as near to it.
NEAR = 120

#: Up to so many terms, or documents with their terms, are broadcast (some tens of MB).
BROADCAST_ROWS = 200_000


def _luhn(digits: Column) -> Column:
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    each = F.transform(F.split(F.reverse(digits), ""), worth)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        d = _digits(v)
        return F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(v)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans (kind, start, end, value) by kind, then start; none for a null text."""
    gates = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"(?:[0-9][\x20-]?){12}"), "phone": F.contains(text, F.lit("+"))}

    def one(kind: str, pattern: str) -> Column:
        found = F.filter(match_spans(text, pattern), lambda s: _valid(kind, s["value"]))
        named = F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        return F.coalesce(F.when(gates[kind], named), F.array().cast(SPAN)).cast(SPAN)

    return F.concat(*(one(kind, pattern) for kind, pattern in zip(KINDS, (EMAIL, IP, CARD, PHONE))))


def _near(text: Column, start: Column, end: Column) -> Column:
    """The entity's line, cut to NEAR characters on either side, without the entity."""
    first = F.greatest(start - NEAR, F.lit(0))
    left = F.substring_index(F.substr(text, first + 1, start - first), "\n", -1)
    right = F.substring_index(F.substr(text, end + 1, F.lit(NEAR)), "\n", 1)
    return F.concat(left, F.lit(" \n "), right)


def _terms(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(TERM), F.lit(0)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("x"), text.alias("_t"))


def _small(side: DataFrame) -> DataFrame:
    """Written once; broadcast if it has at most BROADCAST_ROWS rows, else left to a shuffle join."""
    side = materialize(side)
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def disclosing_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = 3, generalise: float = 0.7, remove: float = 0.9) -> DataFrame:
    """One row per disclosing term: term, action (generalise or remove), disclosure (its largest), entities (their number).

    All documents count. ``support`` is the number of different contexts in which term and entity must meet, so copies of
    one passage are one observation. Terms are letters, in lower case, with digits, hyphens and apostrophes inside.
    """
    terms, _, _ = _disclosure(_rows(docs, id_col, text_col), support, generalise, remove)
    return terms


def _disclosure(rows: DataFrame, support: int, generalise: float, remove: float):
    """Terms; the documents (doc_id, x, term) in which candidates occur; the base spans per document row."""
    based = rows.select("doc_id", "x", "_t", base_spans(F.col("_t")).alias("base"))
    near = F.transform(
        F.col("base"),
        lambda s: F.struct(F.concat_ws(":", s["kind"], F.lower(s["value"])).alias("entity"), _near(F.col("_t"), s["start"], s["end"]).alias("near")),
    )
    spans = materialize(based.select("doc_id", "x", "base", F.when(F.size("base") > 0, near).alias("near")))
    met = spans.select("doc_id", "x", F.inline("near")).select(
        "doc_id", "x", "entity", F.xxhash64("near").alias("context"), F.explode(_terms(F.col("near"))).alias("term")
    )
    contexts = met.groupBy("entity", "term", "context").agg(F.count("*").alias("rows"))
    pairs = materialize(contexts.groupBy("entity", "term").agg(F.count("*").alias("contexts")).where(F.col("contexts") >= support))
    joint = met.select("doc_id", "x", "entity", "term").distinct().join(pairs, ["entity", "term"], "left_semi")
    n_both = joint.groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    n_entity = spans.select("doc_id", "x", F.explode(F.array_distinct(F.transform("near", lambda s: s["entity"]))).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    wanted = _small(pairs.select("term").distinct())
    held = materialize(rows.select("doc_id", "x", F.explode(_terms(F.col("_t"))).alias("term")).join(wanted, "term", "left_semi"))
    n_term = held.groupBy("term").agg(F.count("*").alias("n_term"))
    total = spans.count()
    scored = n_both.join(n_entity, "entity").join(n_term, "term").withColumn(
        "disclosure",
        F.when(F.col("n_entity") < total, F.log(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term"))) / F.log(F.lit(float(total)) / F.col("n_entity"))),
    )
    terms = scored.where(F.col("disclosure") >= generalise).groupBy("term").agg(F.max("disclosure").alias("disclosure"), F.count("*").alias("entities"))
    action = F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise")
    return materialize(terms.select("term", action.alias("action"), "disclosure", "entities")), held, spans


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = 3, generalise: float = 0.7, remove: float = 0.9) -> DataFrame:
    """One row per input row: doc_id, x (hash of the text), ``base`` spans and ``terms`` spans (kind: generalise or remove).

    Starts and ends are code points, ends exclusive. Null texts count as empty. Repeated rows are found alike, each;
    null ids stay null. Term spans that touch a base span are left out: the base span covers them.
    """
    rows = _rows(docs, id_col, text_col)
    terms, held, spans = _disclosure(rows, support, generalise, remove)
    per_doc = held.distinct().join(terms, "term").groupBy("doc_id", "x").agg(F.collect_set(F.struct("term", "action")).alias("_terms"))
    per_doc = per_doc.select(F.col("doc_id").alias("_d"), F.col("x").alias("_x"), "_terms")
    some = rows.join(_small(per_doc), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("x") == F.col("_x"))).dropDuplicates(["_d", "_x"])

    def act(s: Column) -> Column:
        hit = F.filter(F.col("_terms"), lambda t: t["term"] == F.lower(s["value"]))
        return F.struct(F.get(hit, 0)["action"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))

    marked = F.filter(F.transform(match_spans(F.col("_t"), TERM), act), lambda s: s["kind"].isNotNull())
    termed = some.select("_d", "_x", marked.cast(SPAN).alias("terms"))
    met = spans.join(termed, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("x") == F.col("_x")), "left")
    clear = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    return met.select("doc_id", "x", "base", F.coalesce(F.filter("terms", clear), F.array().cast(SPAN)).alias("terms"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows, all columns: base spans masked, terms replaced by their class or removed in ``text_col``.

    A term is generalised to <TERM>, removed as <>; entities become <EMAIL>, <IP>, <CARD>, <PHONE>. Of overlapping spans the
    leftmost is masked together with the rest of the ones it touches.
    """
    found = find(docs, id_col, text_col, **options).where((F.size("base") > 0) | (F.size("terms") > 0)).dropDuplicates(["doc_id", "x"])
    both = F.array_sort(F.transform(F.concat("base", "terms"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names = F.create_map(*(F.lit(v) for pair in (("email", "<EMAIL>"), ("ip", "<IP>"), ("card", "<CARD>"), ("phone", "<PHONE>"), ("generalise", "<TERM>"), ("remove", "<>")) for v in pair))

    def join(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["mark"].alias("mark"))
        own = F.struct(s["start"].alias("start"), s["end"].alias("end"), names[s["kind"]].alias("mark"))
        touching = (F.size(acc) > 0) & F.coalesce(last["end"] > s["start"], F.lit(False))
        return F.when(touching, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(own)))

    spans = F.aggregate(both, F.array().cast("array<struct<start:int,end:int,mark:string>>"), join)
    d, x, cut = fresh("d"), fresh("x"), fresh("spans")
    keyed = found.select(F.col("doc_id").alias(d), F.col("x").alias(x), spans.alias(cut))
    text = F.coalesce(F.col(text_col), F.lit(""))
    met = docs.join(keyed, F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(text) == F.col(x)), "left")
    out = F.when(F.col(cut).isNotNull(), redacted(F.col(text_col), F.col(cut), None)).otherwise(F.col(text_col))
    return met.select(*(out.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
