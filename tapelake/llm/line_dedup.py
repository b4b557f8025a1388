"""Lines that many documents share are dropped from all of them but the last.

Every text is exploded into its lines. A line's key is the line without white space at its ends, with A to Z lower-cased;
of the keys only hashes of 128 bits travel. Documents are counted once for each hash (first by hash and document, so that
no line, however common, gathers in one task), and lines whose key stands in enough documents are dropped wherever they
are not in the largest doc_id that holds them. What comes back to a document is the places of its dropped lines; the text
is put together again from the places that are left.

Skew: keys that make up over a thousandth of all crowded occurrences are at most a thousand, so they are broadcast; the
occurrences of all others are joined by a shuffle on the key. The texts are shuffled once, by document.

Defined results: a null or empty text is one empty line, and ``clean`` leaves it as it is. Rows that share a doc_id count as
one document, null ids too; a null id is smaller than any other. Each repeated row gets its own result. An empty table
gives an empty result. Extra columns are kept by ``clean`` and not read, whatever their names. A text's lines are held in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import fresh, written

MIN_CHARS = 20
MIN_DOCUMENTS = 3
#: A key with more than one part in so many of all crowded occurrences is broadcast; there are at most so many.
HOT_PARTS = 1000

SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["h1", "h2"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key(line: Column) -> Column:
    """The line by which equal lines are found."""
    bare = F.btrim(line, F.lit(SPACES))
    # Of a line without characters beyond ASCII, lower() changes A to Z only, and is faster.
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, place and the key's hashes of every line that is long enough."""
    exploded = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    long_ = exploded.filter(F.length(F.btrim("line", F.lit(SPACES))) >= MIN_CHARS)
    return long_.select("doc_id", "text_hash", "place", F.xxhash64(key(F.col("line"))).alias("h1"), F.xxhash64(F.lit(1), key(F.col("line"))).alias("h2"))


def crowded(found: DataFrame) -> DataFrame:
    """h1, h2, documents and keeper (the largest doc_id) of the keys in at least MIN_DOCUMENTS documents."""
    once = found.select(*_KEY, "doc_id").distinct()
    return once.groupBy(*_KEY).agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper")).filter(F.col("documents") >= MIN_DOCUMENTS)


def dropped(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and places (of the lines that are dropped) of the documents that lose any."""
    found = written(occurrences(docs), "lines")
    keys = written(crowded(found), "keys")
    total = keys.agg(F.sum("documents")).first()[0] or 0
    hot = F.col("documents") * HOT_PARTS > total
    few = F.broadcast(keys.filter(hot).select(*_KEY, "keeper"))
    common = found.join(few, _KEY)
    others = found.join(few, _KEY, "left_anti").join(keys.filter(~hot).select(*_KEY, "keeper"), _KEY)
    lost = common.unionByName(others).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places"))


def _deduplicated(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """``docs`` and, under the given names, how many lines each has and loses, and what is left."""
    d, h, places, lines = (fresh(x) for x in ("doc", "hash", "places", "lines"))
    lost = dropped(docs).select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), F.col("places").alias(places))
    joined = docs.join(lost, docs["doc_id"].eqNullSafe(F.col(d)) & (F.xxhash64(docs["text"]) == F.col(h)), "left").drop(d, h)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places))
    left = F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    out = joined.withColumn(lines, _lines(F.col("text")))
    out = out.withColumns(
        {
            names["n_lines"]: F.size(lines).cast("long"),
            names["n_dropped"]: F.coalesce(F.size(places), F.lit(0)).cast("long"),
            names["kept"]: F.when(F.col(places).isNull(), F.col("text")).otherwise(left),
        }
    )
    return out.drop(lines, places)


_NAMES = ["n_lines", "n_dropped", "kept"]


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped and kept (the text that is left) of every document."""
    return _deduplicated(docs.select("doc_id", "text"), {n: n for n in _NAMES}).select("doc_id", *_NAMES)


def clean(docs: DataFrame) -> DataFrame:
    """The documents without the lines that are dropped; n_chars, where there is one, follows the text."""
    names = {n: fresh(n) for n in _NAMES}
    out = _deduplicated(docs, names).withColumn("text", F.col(names["kept"]))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
