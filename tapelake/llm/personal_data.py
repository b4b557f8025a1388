"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Four kinds are found by pattern and are always kept: email, ip, card, phone. Every other token that looks like an identifier
(eight characters or more, four digits or more) is a candidate. The four kinds are seeds, and so are candidates that say what
they are: long tokens of letters and digits that a word such as ``token`` or ``key`` is set to. Seeds and candidates are
instances; the word to the left with the signs between (past blanks and quotes), the word to the right and the shape of an
occurrence are its lexical patterns. Patterns and instances form a graph that is scored round by round: a pattern by the mean
of its instances, damped where there are few, an instance by the mean of its patterns or, if that is more, by a word that
values are set by; seeds stay at one. Candidates that end
above the threshold, by way of a pattern that is itself trusted and was seen with several instances, are identifiers that the
patterns discovered, and so are all their occurrences: a value that is found out beside ``token =`` is found alone as well.

The graph is joins and grouped sums over (pattern, instance) rows; no pattern's instances meet in one row. Positions in a
text are worked out within its row. The text itself is shuffled only by ``redact``.

Defined results: a null or empty text has no spans; repeated rows each get the same; a null doc_id is an id like any other;
an empty table gives an empty result. Extra columns are kept by ``redact`` and not read by ``find``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import block_sums, sum_before
from tapelake.llm.common import fresh, written

# The four patterns. Each is written so that the expression engine does not try a run of characters again from
# its middle and never goes back into a repetition: lookbehind and possessive repeats change no match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

KINDS = ["email", "ip", "card", "phone", "id"]  # "id": what the method finds of other shapes
CANDIDATE = (
    r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)[\x20.-]?)?[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9])"
    r"|(?<![A-Za-z0-9])(?=[A-Za-z0-9])(?=[A-Za-z._@%+/-]*+[0-9])[A-Za-z0-9][A-Za-z0-9._@%+/-]{6,}[A-Za-z0-9](?![A-Za-z0-9])"
)
MIN_DIGITS = 4
# What a token that says what it is looks like, patterns of words that set values, and those that set secrets.
SECRET = r"^(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{20,}$"  # it has MIN_DIGITS digits, being a candidate
SETS = r"^L .*[:=#]$"
SECRET_LEFT = r"(?:token|secret|key|passwd|password|pwd|credential|auth|bearer)s?[:=]+$"
ROUNDS = 4
DAMPING = 1.0
THRESHOLD = 0.5
TRUSTED, SUPPORT = 0.5, 3

SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,left:string,right:string>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def _is_card(x: Column) -> Column:
    d = _digits(x)
    return F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(F.lit(False))


VALID = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: x.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": _is_card,
    "phone": lambda x: F.length(_digits(x)).between(9, 15),
    "id": lambda x: F.length(_digits(x)) >= MIN_DIGITS,
}
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "id": CANDIDATE}


# A word, however long, is tried from its first letter only and never again from its middle, so both are linear.
_WORD = r"[\p{L}\p{N}_]"
_LEFT = rf"(?<!{_WORD})({_WORD}++)([^\p{{L}}\p{{N}}_\n]*+)$"
_RIGHT = rf"^[^\p{{L}}\p{{N}}_\n]*+({_WORD}++)"


def _left_word(gap: Column) -> Column:
    """The last word of a gap, with numbers as 0, and the signs after it, without blanks and quotes."""
    signs = F.regexp_replace(F.regexp_extract(gap, _LEFT, 2), r"[\s\"'`]", "")
    return F.concat(F.regexp_replace(F.lower(F.regexp_extract(gap, _LEFT, 1)), "[0-9]+", "0"), signs)


def _right_word(gap: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(gap, _RIGHT, 1)), "[0-9]+", "0")


def _with_spans(df: DataFrame, text: Column, kind: str, name: str) -> DataFrame:
    """All valid matches of a kind with their places (code points) and contexts, in a new column."""
    found, gaps, lengths, sums = (fresh(x) for x in ("found", "gaps", "lengths", "sums"))
    some = F.coalesce(text.contains("@") if kind == "email" else text.rlike("[0-9]"), F.lit(False))
    nothing = F.array().cast("array<string>")
    df = df.withColumns(
        {
            found: F.when(some, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(nothing),
            gaps: F.when(some, F.split(text, PATTERNS[kind])).otherwise(nothing),
        }
    )
    gap = lambda i: F.get(gaps, i)
    df = df.withColumn(lengths, F.transform(found, lambda x, i: (F.length(gap(i)) + F.length(x)).cast("long"))).withColumn(sums, block_sums(F.col(lengths)))

    def span(x: Column, i: Column) -> Column:
        start = sum_before(F.col(lengths), F.col(sums), i) + F.length(gap(i))
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(x)).alias("end"), x.alias("value"), _left_word(gap(i)).alias("left"), _right_word(gap(i + 1)).alias("right")
        )

    matched = F.filter(F.transform(found, lambda x, i: F.when(VALID[kind](x), span(x, i))), lambda s: s.isNotNull())
    return df.withColumn(name, matched.cast(f"array<{SPAN}>")).drop(found, gaps, lengths, sums)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, base (the four kinds' spans in order) and candidates (other identifier-like tokens)."""
    df = _keyed(docs)
    for kind in KINDS:
        df = _with_spans(df, F.col("text"), kind, kind)
    base = F.concat(*[F.col(k) for k in KINDS[:4]])
    df = df.select("doc_id", "text_hash", base.alias("base"), F.col("id").alias("candidates"))
    free = F.filter("candidates", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return df.withColumn("candidates", free)


def shape(value: Column) -> Column:
    """Digit runs as 0, letter runs as a, runs of both as x; other characters as they are."""
    plain = F.regexp_replace(F.regexp_replace(value, "[0-9]+", "0"), "[A-Za-z]+", "a")
    return F.regexp_replace(plain, "(?:a0|0a)[a0]*", "x")


def kind_of(value: Column) -> Column:
    """The kind that a discovered identifier looks like."""
    s = shape(value)
    return (
        F.when(value.contains("@"), "email")
        .when((s == "0.0.0.0"), "ip")
        .when(value.startswith("+"), "phone")
        .when((s.rlike(r"^0(?:[ -]0)*$")) & F.length(_digits(value)).between(13, 19), "card")
        .otherwise("id")
    )


def says_what_it_is(span: Column) -> Column:
    """Whether a candidate is a long token that a word for secrets is set to."""
    return F.coalesce(span["value"].rlike(SECRET) & span["left"].rlike(SECRET_LEFT), F.lit(False))


def edges(found: DataFrame) -> DataFrame:
    """pattern, instance, seed: each once."""
    known = found.select(F.explode("base").alias("s"), F.lit(1).alias("seed"))
    others = found.select(F.explode("candidates").alias("s"))
    rows = known.unionAll(others.select("s", says_what_it_is(F.col("s")).cast("int").alias("seed")))
    value = F.lower("s.value")
    patterns = F.array(F.concat(F.lit("L "), "s.left"), F.concat(F.lit("R "), "s.right"), F.concat(F.lit("S "), shape(F.col("s.value"))))
    return rows.select(F.explode(patterns).alias("pattern"), value.alias("instance"), "seed").groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))


def scored(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The seeds, which may stand elsewhere too, and the instances that trusted patterns discover."""
    graph = written(graph, "pattern-graph")
    instances = graph.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    for _ in range(rounds):
        weighed = graph.join(instances, "instance")
        patterns = weighed.groupBy("pattern").agg(F.sum("score").alias("total"), F.count("*").alias("n")).withColumn("trust", F.col("total") / (F.col("n") + DAMPING))
        support = F.max((F.col("trust") >= TRUSTED) & (F.col("n") >= SUPPORT)).alias("supported")
        # Words of prose stand before seeds by chance, so they count together; a word that sets values counts by itself.
        alone = F.max(F.when(F.col("pattern").rlike(SETS) & (F.col("n") >= SUPPORT), F.col("trust")))
        score = F.greatest(F.avg("trust"), F.coalesce(alone, F.lit(0.0))).alias("found")
        instances = graph.join(patterns, "pattern").groupBy("instance").agg(F.max("seed").alias("seed"), score, support)
        instances = instances.select("instance", F.when(F.col("seed") == 1, 1.0).otherwise(F.col("found")).alias("score"), "seed", "supported")
        instances = written(instances, "instance-scores")
    return instances.filter((F.col("seed") == 1) | (F.col("score") >= THRESHOLD) & F.col("supported")).select("instance")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, base and added: the spans of the four kinds, and those that the patterns discovered."""
    found = written(occurrences(docs), "occurrences")
    discovered = scored(edges(found))
    rows = found.filter(F.size("candidates") > 0).select("doc_id", "text_hash", F.explode("candidates").alias("s")).withColumn("instance", F.lower("s.value"))
    span = F.struct(kind_of(F.col("s.value")).alias("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    d, h = fresh("d"), fresh("h")
    added = rows.join(discovered, "instance").groupBy(F.col("doc_id").alias(d), F.col("text_hash").alias(h)).agg(F.collect_set(span).alias("added"))
    out = found.join(added, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col("text_hash") == F.col(h)), "left")
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select("doc_id", "text_hash", plain.alias("base"), F.coalesce("added", F.slice(plain, 1, 0)).alias("added"))


def _listed(spans: Column) -> Column:
    """kind:start:end, by kind in the order of KINDS, then start."""
    order = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(order, (s["k"] - 1).cast("int")), s["start"], s["end"])), ",")


def _is_of(kind: str):
    return lambda s: s["kind"] == kind


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: how many base spans of each kind, their digest, and all spans listed."""
    counts = [F.size(F.filter("base", _is_of(k))).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    return find(docs).select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def _merged(spans: Column) -> Column:
    """Spans by start; those that overlap become one, of the first one's kind."""
    span = "struct<start:bigint,end:bigint,kind:string>"
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")).cast(span)))

    def step(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind")).cast(span)
        return F.when(s["start"] < last["end"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(ordered, F.array().cast(f"array<{span}>"), step)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; n_chars, where there is one, follows the text."""
    spans, d, h, key = (fresh(x) for x in ("spans", "d", "h", "key"))
    found = find(docs).select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), _merged(F.concat("base", "added")).alias(spans)).filter(F.size(spans) > 0).dropDuplicates([d, h])
    out = docs.withColumn(key, F.xxhash64("text")).join(found.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(key) == F.col(h)), "left")
    text, s = F.col("text"), F.col(spans)
    before = lambda i: F.coalesce(F.get(s, i - 1)["end"], F.lit(0))
    parts = F.transform(s, lambda x, i: F.concat(F.substring(text, (before(i) + 1).cast("int"), (x["start"] - before(i)).cast("int")), F.lit("["), F.upper(x["kind"]), F.lit("]")))
    rest = F.substring(text, (before(F.size(s)) + 1).cast("int"), F.length(text))
    out = out.withColumn("text", F.when(s.isNull(), text).otherwise(F.concat(F.array_join(parts, ""), rest)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(s.isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
