"""Secret scan: a wide net of candidates, false positives removed by a random forest on their features.

Candidates are long tokens with a digit, whatever is assigned to a name like password or api_key, what stands behind bearer or basic, passwords in front of
an @ in addresses, and blocks of private keys. Not seen are secrets that none of these shapes shows: a short or letters-only
one in running text without a name before it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake.llm.common import SPAN, bound, match_spans
from curvelake.operators.joins import fresh
from curvelake.session import materialize

#: A run of key characters, 16 or more, with a digit in it, not part of a longer run.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}+"

NAMES = r"(?:token|secret|passw(?:or)?d|passphrase|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?|credentials?)"

#: Further shapes: the pattern, then the pattern whose last group, at the end of the match but for ``tail`` characters, is the value.
ASSIGNED = rf"""(?i){NAMES}[\w-]{{0,12}}["']?\s{{0,3}}(?::=|=>|[=:])\s{{0,3}}(?:"[^"\n]{{4,512}}"|'[^'\n]{{4,512}}'|[^\s"'<>,;]{{6,512}})"""
BEARER = r"(?i)\b(?:bearer|basic)\s{1,3}[A-Za-z0-9._~+/=-]{12,2048}"
ADDRESS = r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@"'<>]{0,64}:[^\s/@"'<>]{3,256}@"""
LOGIN = r"""(?<![A-Za-z0-9._/:-])[A-Za-z0-9._-]{2,32}:[^\s/@:"'<>]{4,64}@(?=[A-Za-z0-9])"""
BLOCK = (
    r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY[A-Z ]{0,10}-----(?:\s++[A-Za-z0-9+/=]{20,}+)*+"
    r"(?:(?:\s++[A-Za-z0-9+/=]{1,19}+)?+\s*+-----END [A-Z0-9 ]{0,40}-----)?"
)

#: Characters looked at before and after a candidate.
BEFORE, AFTER = 40, 12

#: Words that stand in names, paths and placeholders but not in keys.
WORDS = (
    "the and for with that this from have not are was you all data file name test user path home page news item index "
    "main post image thumb small large static assets article product version release update build node docs wiki "
    "download example sample dummy change your here key token secret password service client server config default "
    "value number string public private account report summary section chapter table list order blog archive media"
).split()
KEYWORDS = r"(token|secret|passw(or)?d|pwd|api.?key|auth(orization)?|credentials?|private.?key|access.?key|bearer|client.?id)"
DIGESTS = r"(sha-?1|sha-?256|sha-?512|md5|crc|commit|checksum|digest|etag|revision|rev|uuid|guid|hash|integrity|isbn|order|invoice|phone|card|id)"
PREFIXES = r"^(AKIA|ASIA|gh[pousr]_|github_pat_|xox[baprs]-|sk_live_|rk_live_|sk-|AIza|glpat-|eyJ|SG\.|npm_)"
LITERALS = (
    r"^[\[({*$%#@!.\"']*(none|null|nil|true|false|undefined|required|optional|string|redacted|removed|hidden|masked|unknown|default|empty|missing|invalid|expired|"
    r"os\.|process\.|env|get|config|settings|self\.|this\.|input|prompt|argv|request\.|params|vault|\$|%|\{\{|x+$|\*+$|\.+$)"
)
PLACEHOLDERS = r"(example|sample|dummy|your|change|placeholder|test|xxxx|0{6}|1234567|abcdef)"

FEATURES = (
    "length digit_share upper_share mark_share distinct_share transitions hex_only covered vowel_share slashes "
    "in_path prefixed placeholder keyword assigned quoted digest login block literal other_marks blanks has_digit called"
).split()


def _features(c: DataFrame) -> DataFrame:
    """Numbers from value, before and after."""
    v, n = F.col("value"), F.length("value")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    low, before = F.lower("value"), F.lower("before")
    known = F.length(low) - F.length(F.regexp_replace(low, "(" + "|".join(w for w in WORDS if len(w) > 2) + ")", ""))
    flag = lambda x: F.when(x, 1.0).otherwise(0.0)
    return c.withColumns(
        {
            "length": F.least(n, F.lit(400)).cast("double"),
            "digit_share": share("[0-9]"),
            "upper_share": share("[A-Z]"),
            "mark_share": share("[+/_=-]"),
            "distinct_share": F.size(F.array_distinct(F.split(F.substring(v, 1, 64), ""))) / F.least(n, F.lit(64)),
            "transitions": share(r"(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"),
            "hex_only": flag(v.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
            "covered": known / n,
            "vowel_share": F.regexp_count(low, F.lit("[aeiou]")) / F.greatest(F.regexp_count(low, F.lit("[a-z]")), F.lit(1)),
            "slashes": F.least(F.regexp_count(v, F.lit("/")), F.lit(8)).cast("double"),
            "in_path": flag(F.col("before").rlike(r"[/\\.@#?&]$") | F.col("after").rlike(r"^(\.[a-z]{2,4}\b|[\\/?])")),
            "prefixed": flag(v.rlike(PREFIXES)),
            "placeholder": flag(low.rlike(PLACEHOLDERS)),
            "keyword": flag(before.rlike(KEYWORDS + r"[^a-z]{0,4}\w{0,8}[^a-z0-9]{0,6}$")),
            "assigned": flag(before.rlike(r"[=:]\s{0,3}[\"']?$")),
            "quoted": flag(before.rlike("[\"']$") & F.col("after").rlike("^[\"']")),
            "login": flag(before.rlike(r"[^\s:@]{0,64}:$") & F.col("after").startswith("@")),
            "block": flag(v.startswith("-----BEGIN")),
            "literal": flag(low.rlike(LITERALS)),
            "other_marks": share(r"[^A-Za-z0-9+/_=\s-]"),
            "blanks": share(r"\s"),
            "has_digit": flag(v.rlike("[0-9]")),
            "called": flag(v.rlike(r"[(\[{]") | F.col("after").rlike(r"^[(\[{]")),
            "digest": flag(before.rlike(r"\b" + DIGESTS + r"\b[^a-z]{0,8}$")),
        }
    )


def labelled_findings(spark: SparkSession, n: int = 6_000, seed: int = 7) -> DataFrame:
    """``n`` labelled findings (value, before, after, label), drawn from kinds of keys and of look-alikes by a
    hash of their number: the same rows on every run, a bounded training set by documented parameter."""
    rows = spark.range(0, n, 1, 4)
    draw = lambda k, m: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(m))
    pick = lambda k, values: F.get(F.array(*(F.lit(x) for x in values)), draw(k, len(values)).cast("int"))
    raw = F.sha2(F.concat_ws("-", "id", F.lit(seed)).cast("binary"), 512)
    b64 = F.translate(F.base64(F.unhex(raw)), "\r\n", "")
    word = lambda k: pick(k, WORDS)
    dash = lambda *parts: F.concat_ws("-", *parts)
    digits = F.translate(raw, "abcdef", "012345")
    names = ["token", "secret", "password", "api_key", "apikey", "API_KEY", "access_key", "auth_token", "client_secret", "TOKEN"]
    ops = [' = "', '="', ": ", " = ", '": "', "='", "=", ' := "']
    keys = [
        F.substring(raw, 1, 40), F.upper(F.substring(raw, 1, 40)), F.substring(raw, 1, 32), F.substring(raw, 1, 64),
        F.substring(b64, 1, 40), F.concat(F.substring(b64, 1, 43), F.lit("=")),
        F.concat(F.lit("AKIA"), F.upper(F.substring(F.regexp_replace(b64, "[^A-Za-z]", ""), 1, 15)), F.lit("7")),
        F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(b64, "[+/=]", "4"), 1, 36)),
        F.concat(F.lit("sk_live_"), F.substring(F.regexp_replace(b64, "[+/=]", "a"), 1, 24)),
        F.concat(F.lit("xoxb-"), F.substring(digits, 1, 12), F.lit("-"), F.substring(F.regexp_replace(b64, "[+/=]", "Z"), 1, 24)),
    ]
    others = [
        F.substring(digits, 1, 16),
        F.substring(raw, 1, 40),
        F.substring(raw, 1, 32),
        dash(F.substring(raw, 1, 8), F.substring(raw, 9, 4), F.substring(raw, 13, 4), F.substring(raw, 17, 4), F.substring(raw, 21, 12)),
        F.concat_ws("/", word(1), word(2), F.substring(digits, 1, 4), word(3), word(4)),
        dash(word(5), word(6), word(7), F.substring(digits, 1, 3)),
        F.concat(F.lit("2"), F.substring(digits, 1, 3), F.lit("-"), F.substring(digits, 4, 2), F.lit("-"), F.substring(digits, 6, 2), F.lit("_"), word(8), F.lit("_"), word(9)),
        F.concat(F.initcap(word(10)), F.initcap(word(11)), F.initcap(word(12)), F.substring(digits, 1, 2)),
        F.concat(F.lit("example_"), word(13), F.lit("_123456789")),
        F.concat(F.lit("your-"), word(14), F.lit("-"), word(15), F.lit("-here0")),
    ]
    plain = ["in of the ", "see also ", "https://www.site.example/", "/usr/share/", "card ", "order ", "commit ", "sha1 ", "md5: ", "checksum = ", "uuid: ", "img src=\"/", "id="]
    choice = lambda k, values: F.element_at(F.array(*values), (draw(k, len(values)) + 1).cast("int"))
    secret = draw(20, 2) == 1
    assigned = F.concat(pick(21, ["", "and ", "set ", "\n", "export ", "let "]), pick(22, names), pick(23, ops))
    # look-alikes of the last two kinds stand behind a keyword as well
    kind = draw(24, len(others))
    context = F.when(kind >= 8, assigned).otherwise(pick(25, plain))
    known_key = draw(26, len(keys))
    near = F.when((known_key >= 6) & (draw(27, 3) == 0), pick(28, ["use ", "key: ", "(", "curl -u "])).otherwise(assigned)
    return rows.select(
        F.when(secret, F.element_at(F.array(*keys), (known_key + 1).cast("int")))
        .otherwise(F.element_at(F.array(*others), (kind + 1).cast("int")))
        .alias("value"),
        F.when(secret, near).otherwise(context).alias("before"),
        F.when(secret, pick(29, ['"', "'", "\n", " ", '",'])).otherwise(pick(30, [" ", "\n", ".html", '"', "/", ", "])).alias("after"),
        secret.cast("double").alias("label"),
    )


def assigned_findings(spark: SparkSession, n: int = 3_000, seed: int = 11) -> DataFrame:
    """``n`` labelled findings of the further shapes: passwords, phrases, keys of letters, logins and key blocks, against words, literals and code."""
    rows = spark.range(0, n, 1, 4)
    draw = lambda k, m: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(m))
    choice = lambda k, values: F.element_at(F.array(*values), (draw(k, len(values)) + 1).cast("int"))
    pick = lambda k, values: choice(k, [F.lit(v) for v in values])
    raw = F.sha2(F.concat_ws("/", "id", F.lit(seed)).cast("binary"), 512)
    b64 = F.translate(F.base64(F.unhex(raw)), "\r\n", "")
    digits, letters = F.translate(raw, "abcdef", "012345"), F.translate(raw, "0123456789", "ghijklmnop")
    word, mark = lambda k: pick(k, WORDS), lambda k: pick(k, ["!", "$", "#", "@", "%", "&", "*", "-", "_", ".", "?"])
    length = lambda k, least, most: (draw(k, most - least + 1) + least).cast("int")
    part = lambda c, k, least, most: F.substr(c, F.lit(1), length(k, least, most))
    passwords = [
        F.concat(word(1), part(digits, 2, 1, 4), mark(3), word(4)),
        F.concat(F.initcap(word(1)), mark(2), part(digits, 3, 2, 5), mark(4)),
        F.concat(part(letters, 1, 3, 8), mark(2), F.upper(part(letters, 3, 2, 5)), part(digits, 4, 1, 4)),
        F.concat(part(b64, 1, 8, 14), mark(2)),
        F.concat(F.initcap(part(letters, 1, 4, 9)), part(digits, 2, 1, 3), mark(3)),
        part(raw, 1, 12, 20),
    ]
    password = choice(5, passwords)
    keys = [password, password, part(letters, 6, 18, 40), part(F.regexp_replace(b64, "[^A-Za-z]", ""), 6, 20, 40), F.concat_ws(".", part(b64, 6, 20, 36), part(raw, 7, 20, 60)), F.concat_ws(" ", word(8), word(9), word(10), word(11))]
    others = [
        pick(6, ["required", "optional", "undefined", "redacted", "[hidden]", "********", "xxxxxxxx", "string", "expired", "invalid", "missing", "removed"]),
        pick(7, ["os.environ", "os.getenv(", "process.env.KEY", "config.get(", "settings.KEY", "self.value", "this.value", "request.args", "${VALUE}", "{{value}}", "$VALUE", "%VALUE%", "getpass(", "input("]),
        F.concat(word(8), word(9)), F.concat(F.initcap(word(10)), word(11)), part(letters, 12, 6, 10),
        F.concat(pick(8, ["your_", "my-", "example-", "the_", "changeme_"]), word(9)), F.concat_ws(" ", word(8), word(9), F.lit("is"), word(10)), F.concat(word(8), F.lit("_"), word(9), F.lit("()")),
    ]
    name = pick(20, ["password", "Password", "passwd", "pwd", "secret", "client_secret", "token", "api_key", "API-KEY", "auth_token", "passphrase", "credentials"])
    before = F.concat(pick(21, ["", "set ", "the ", "\n", "my ", "DB_"]), name, pick(22, [" = ", "=", ": ", ' = "', "='", '": "', " := "]))
    shape, secret = draw(23, 10), draw(24, 2) == 1
    block = F.concat(F.lit("-----BEGIN "), pick(25, ["RSA ", "EC ", "OPENSSH ", ""]), F.lit("PRIVATE KEY-----\n"), b64)
    login = pick(26, ["postgres://admin:", "https://user:", "mysql://root:", "ftp://anna:", "ssh deploy:", "curl -u bot:"])
    mail = pick(27, ["mail:", "write to:", "contact:", "see:", "from:"])
    value = F.when(shape == 0, F.when(secret, block).otherwise(choice(28, others))).when(shape <= 2, F.when(secret, password).otherwise(part(letters, 29, 4, 9)))
    lead = F.when((shape == 0) & secret, pick(30, ["", "\n", "key: "])).when((shape > 0) & (shape <= 2), F.when(secret, login).otherwise(mail)).otherwise(before)
    after = F.when((shape > 0) & (shape <= 2), pick(31, ["@db.host", "@example.org", "@10.0.0.1"])).otherwise(pick(32, ['"', "'", "\n", " ", "", ". ", ")"]))
    return rows.select(
        value.otherwise(F.when(secret, choice(33, keys)).otherwise(choice(34, others))).alias("value"),
        lead.alias("before"), after.alias("after"), secret.cast("double").alias("label"),
    )


def default_model(spark: SparkSession) -> RandomForestClassificationModel:
    return train(labelled_findings(spark).unionByName(assigned_findings(spark)))


def train(findings: DataFrame, trees: int = 24, depth: int = 7, seed: int = 7) -> RandomForestClassificationModel:
    """A forest on labelled findings (value, before, after, label)."""
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(materialize(_features(materialize(findings))))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt", subsamplingRate=0.8)
    return forest.fit(materialize(rows.select("features", "label")))


def suspect(text: Column) -> Column:
    """Whether a text has any candidate; null texts have none."""
    shapes = [text.contains(gate) & text.rlike(p) for gate, p in (("://", ADDRESS), ("@", LOGIN), ("-----BEGIN", BLOCK))]
    return F.coalesce(text.rlike(CANDIDATE) | text.rlike(ASSIGNED) | text.rlike(BEARER) | shapes[0] | shapes[1] | shapes[2], F.lit(False))


def _spans(text: Column) -> Column:
    """Candidates of a text; one that lies in a longer one of the further shapes is left out, as it is a part of that."""
    none = F.array().cast(f"array<{SPAN}>")
    found = lambda p: F.coalesce(match_spans(text, p), none)

    def values(pattern: str, group: str, tail) -> Column:
        def one(s: Column) -> Column:
            cut = F.regexp_extract(s["value"], group, 1)
            end = s["end"] - tail(s["value"])
            return F.struct((end - F.length(cut)).alias("start"), end.alias("end"), cut.alias("value"))

        return F.transform(found(pattern), one)

    closed = lambda m: m.rlike("[\"']$").cast("int")
    further = F.concat(
        values(ASSIGNED, r"""(?::=|=>|[=:])\s{0,3}["']?((?<=["'])[^"']+|[^\s"'<>,;]+)["']?$""", closed),
        values(BEARER, r"\s(\S+)$", lambda m: F.lit(0)),
        values(ADDRESS, r":([^\s/@]+)@$", lambda m: F.lit(1)),
        values(LOGIN, r":([^\s/@:]+)@$", lambda m: F.lit(1)),
        found(BLOCK),
    )

    def alone(some: Column) -> Column:
        inside = lambda s: F.exists(some, lambda e: (e["start"] <= s["start"]) & (e["end"] >= s["end"]) & (e["end"] - e["start"] > s["end"] - s["start"]))
        return F.filter(F.array_distinct(F.concat(found(CANDIDATE), some)), lambda s: (F.length(s["value"]) > 0) & ~inside(s))

    return bound(further, alone)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per candidate: doc_id, x (hash of the text), start, end, value, before, after."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    found = rows.where(suspect(F.col("_t"))).select("doc_id", "_t", F.explode(_spans(F.col("_t"))).alias("s"))
    cut = lambda a, b: F.substring("_t", a, b)
    first = F.greatest(F.col("s.start") - BEFORE, F.lit(0))
    return found.select(
        "doc_id", F.xxhash64("_t").alias("x"), "s.start", "s.end", "s.value",
        cut(first + 1, F.col("s.start") - first).alias("before"), cut(F.col("s.end") + 1, F.lit(AFTER)).alias("after"),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model=None, threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, x, start, end (code points, end exclusive), value, score, secret.

    Candidates are found in whole texts. Null and empty texts have none. Repeated rows are scanned each, a null id stays null.
    An empty table has none. Without a model one is trained on :func:`labelled_findings` and :func:`assigned_findings`.
    """
    if model is None:
        model = default_model(docs.sparkSession)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_features(candidates(docs, id_col, text_col)))
    score = vector_to_array("probability")[1]
    return model.transform(rows).select("doc_id", "x", "start", "end", "value", score.alias("score"), (score >= threshold).alias("secret"))


def redacted(text: Column, spans: Column, mark: str | None) -> Column:
    """``text`` with the sorted spans (start, end) replaced by the mark, or without one by each span's own ``mark``."""
    begin = lambda i: F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(F.lit(0))
    heads = F.transform(spans, lambda s, i: F.concat(F.substr(text, begin(i) + 1, s["start"] - begin(i)), s["mark"] if mark is None else F.lit(mark)))
    return F.concat(F.array_join(heads, ""), F.substr(text, F.element_at(spans, -1)["end"] + 1))


def _apart(spans: Column) -> Column:
    """Sorted spans, those that overlap joined into one."""

    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        touching = (F.size(acc) > 0) & F.coalesce(last["end"] > s["start"], F.lit(False))
        return F.when(touching, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), add)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model=None, threshold: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """The input rows, all columns, with every secret in ``text_col`` replaced by ``mark``.

    Only rows with a candidate are joined with the findings; all others pass without a shuffle.
    """
    found = scan(docs, id_col, text_col, model, threshold).where("secret")
    spans = found.groupBy("doc_id", "x").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    spans = spans.withColumn("_spans", _apart(F.col("_spans")))
    d, x, cut = fresh("d"), fresh("x"), fresh("spans")
    spans = spans.select(F.col("doc_id").alias(d), F.col("x").alias(x), F.col("_spans").alias(cut))
    has = suspect(F.col(text_col))
    some = docs.where(has)
    met = some.join(spans, F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(text_col) == F.col(x)), "left")
    text = F.when(F.col(cut).isNotNull(), redacted(F.col(text_col), F.col(cut), mark)).otherwise(F.col(text_col))
    return docs.where(~has).unionByName(met.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns)))
