"""One query per corpus operator, over its whole table, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake.llm import embeddings, licenses, lines, merkle, mixing, negatives, packing, pieces, pii, quality, rules, secrets, simhash
from curvelake.llm.common import lower_ascii

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BLANK = r"[\t-\r ]+"

SQL9 = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{BLANK}'), lambda x: x <> '') AS words,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\t-\r ]')) AS lines
    FROM texts),
windows AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS v
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, v) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY 1),
m AS (
    SELECT w.doc_id, len(words)::BIGINT AS n_words,
           length(regexp_replace(t, '{BLANK}', '', 'g'))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
           len(lines)::BIGINT AS n_lines, (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaimed
    FROM w LEFT JOIN covered USING (doc_id)),
f AS (
    SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
        + CASE WHEN 100 * n_dup_lines > 70 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars > 20 * n_words OR word_chars < 2 * n_words THEN 16 ELSE 0 END
        + CASE WHEN 2 * n_exclaimed > n_words THEN 32 ELSE 0 END)::BIGINT AS failed
    FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f
"""


@query("op9_quality_rules", SQL9)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(rules.ledger(table(spark, sf_dir, "documents")), "v1")


SQL10 = rf"""
WITH cut AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS l
    FROM documents),
w AS (SELECT doc_id, l, line, list_filter(regexp_split_to_array(line, '{BLANK}'), lambda x: x <> '') AS words FROM cut),
long AS (SELECT doc_id, l, words, (doc_id, l) AS place FROM w WHERE len(words) >= 5),
firsts AS (SELECT words, min(place) AS place FROM long GROUP BY words),
variants AS (
    SELECT place, n, i, list_concat(words[1:i - 1], words[i + 1:]) AS rest
    FROM (SELECT place, words, len(words) AS n, unnest(range(1, len(words) + 1)) AS i FROM firsts)),
replaced AS (
    SELECT place FROM variants QUALIFY place > min(place) OVER (PARTITION BY n, i, rest)),
inserted AS (
    SELECT greatest(f.place, v.place) AS place FROM firsts f JOIN variants v ON f.words = v.rest),
stay AS (
    SELECT place FROM firsts WHERE place NOT IN (SELECT place FROM replaced UNION ALL SELECT place FROM inserted)),
marked AS (
    SELECT doc_id, l, line, len(words) < 5 OR (doc_id, l) IN (SELECT place FROM stay) AS kept FROM w)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (kept)::BIGINT AS n_kept,
       md5(coalesce(string_agg(line, chr(10) ORDER BY l) FILTER (kept), '')) AS text_md5
FROM marked GROUP BY doc_id
"""


@query("op10_line_dedup", SQL10)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those kept, and a digest of the text that is left."""
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return out.select(
        "doc_id",
        F.col("_lines").cast("long").alias("n_lines"),
        F.col("_kept").cast("long").alias("n_kept"),
        F.md5("text").alias("text_md5"),
    )


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("start").cast("long"), F.col("end").cast("long"), F.sha2("value", 256).alias("value_sha256"), "score", "secret")


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = pii.span_text(F.col("base"))
    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.KINDS),
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(pii.span_text(F.col("terms")), F.lit(""))).alias("spans"),
    )


@query("op5_embedding_dedup")
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.select("vec_id", "n_links", "component_id", "kept")


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, table(spark, sf_dir, "labels"))


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and digest of its ids, and whether decoding them gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return pieces.transcode(docs).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_xxhash64"),
        (F.col("back") == F.replace("text", F.lit(pieces.BLANK), F.lit(" "))).alias("round_trip"),
    )


FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
LEAF = "sha256(" + " || ".join(FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 of the decimal doc_id: each byte is a number from 0, each of the eight shifts after it a -1.
CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: list_prepend(ascii(c)::BIGINT, list_resize([-1::BIGINT], 8, -1::BIGINT))))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)"""

SQL12 = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, {LEAF.format(text="text")} AS leaf, CASE WHEN {CRC32} % 5 = 0 THEN {LEAF.format(text=LOWERED)} ELSE {LEAF.format(text="text")} END AS probe
    FROM documents),
placed AS (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
    FROM leaves),
lower_tree AS (
    SELECT 0 AS lv, tree, place, leaf AS node, n FROM placed
    UNION ALL
    SELECT lv + 1, tree, place // 16, sha256(string_agg(node, '' ORDER BY place)), (n + 15) // 16
    FROM lower_tree WHERE n > 1 GROUP BY lv, tree, place // 16, n),
subroots AS (SELECT tree, node FROM lower_tree WHERE n = 1),
upper_tree AS (
    SELECT 0 AS lv, tree AS place, node, (SELECT count(*) FROM subroots) AS n FROM subroots
    UNION ALL
    SELECT lv + 1, place // 16, sha256(string_agg(node, '' ORDER BY place)), (n + 15) // 16
    FROM upper_tree WHERE n > 1 GROUP BY lv, place // 16, n),
nodes AS (
    SELECT lv, tree, place, node, (SELECT max(lv) FROM lower_tree t WHERE t.tree = l.tree) AS top FROM lower_tree l WHERE n > 1),
steps AS (
    SELECT p.tree, p.place, n.lv, string_agg(node, '' ORDER BY n.place) FILTER (n.place < p.place // (16 ** n.lv)::BIGINT) AS before,
           string_agg(node, '' ORDER BY n.place) FILTER (n.place > p.place // (16 ** n.lv)::BIGINT) AS after
    FROM placed p JOIN nodes n ON p.tree = n.tree AND n.place // 16 = p.place // (16 ** (n.lv + 1))::BIGINT
    GROUP BY p.tree, p.place, n.lv
    UNION ALL
    SELECT p.tree, p.place, 1000 + n.lv, string_agg(node, '' ORDER BY n.place) FILTER (n.place < p.tree // (16 ** n.lv)::BIGINT),
           string_agg(node, '' ORDER BY n.place) FILTER (n.place > p.tree // (16 ** n.lv)::BIGINT)
    FROM placed p JOIN upper_tree n ON n.n > 1 AND n.place // 16 = p.tree // (16 ** (n.lv + 1))::BIGINT
    GROUP BY p.tree, p.place, n.lv),
ordered AS (
    SELECT tree, place, coalesce(before, '') AS before, coalesce(after, '') AS after,
           row_number() OVER (PARTITION BY tree, place ORDER BY lv) AS k FROM steps),
folds AS (
    SELECT tree, place, 0 AS k, probe AS node FROM placed
    UNION ALL
    SELECT tree, place, o.k, sha256(before || node || after) FROM folds f JOIN ordered o USING (tree, place) WHERE o.k = f.k + 1),
proofs AS (SELECT tree, place, string_agg(before || after, '' ORDER BY k) AS sides FROM ordered GROUP BY tree, place),
folded AS (SELECT tree, place, arg_max(node, k) AS folded_root FROM folds GROUP BY tree, place),
roots AS (SELECT node AS root FROM upper_tree WHERE n = 1)
SELECT doc_id, leaf, s.node AS subroot, root, sha256(coalesce(sides, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots s USING (tree) LEFT JOIN proofs USING (tree, place) JOIN folded USING (tree, place), roots
"""


@query("op12_merkle_manifest", SQL12)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its leaf, the roots above, a digest of its siblings, and whether the leaf read again (a fifth lower-cased) gives the root."""
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    leaf, lowered = (merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), t) for t in (text, lower_ascii(text)))
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    given = F.struct("doc_id", F.when(touched, lowered).alias("probe"))
    made = merkle.manifest(docs, F.col("source"), F.col("doc_id"), leaf, given)
    proved = merkle.prove(made).select("given.doc_id", "leaf", "subroot", F.lit(made.root).alias("root"), F.coalesce("given.probe", "leaf").alias("probe"), "path")
    folded = proved.withColumn("folded_root", merkle.fold(F.col("probe"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op13_mixing")
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the words that the mix takes of it."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


SQL11 = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, r.label = a.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
    FROM r a JOIN r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query("op11_hard_negatives", SQL11)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the vectors whose id is divisible by 100; where 7 divides the id, the label is moved on by one first."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)
