"""Line-first cleaning with DataFrame functions only.

Each line is held against rules: punctuation (drowned in symbols or exclamation marks, or a fragment that ends without a
sentence end), navigation (a menu: words between separators) and boilerplate (a short line with a stock phrase, or a
longer one whose words are mostly the one before once more). Lines
that fail are removed; a document that loses too large a share of its characters, or keeps too few words, is rejected.
Word statistics of the whole text come first and can reject it as well. Everything happens within a row, so the operator
is a map: no shuffle.

Windows of five words are told apart by their 64-bit hash within one text; at n words two different windows of a text
agree by chance once in 2^64 / n^2 texts.

Defined results: a null text has no words and fails; so does an empty one. Its cleaned text is null or empty. Every input
row gives one row, repeated rows too; an empty table gives an empty result. Extra columns are kept by ``clean`` and not
read by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import fresh

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
MAX_LOST = 0.5
#: Share of a line's characters that may be symbols, of its words that may end in two exclamation marks, and of its words
#: that may be separators.
MAX_SYMBOLS, MAX_SHOUTS, MAX_SEPARATORS = 0.1, 0.3, 0.3
#: Share of the words of a longer line that may equal the word before.
MAX_STUTTER = 0.3
#: A line of fewer words needs a sentence end; a line of more is not taken for a stock phrase.
MIN_OPEN_WORDS, MAX_STOCK_WORDS = 4, 25

SPACES = " \t\n\x0b\x0c\r"
_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"
_SENTENCE_END = r"[.!?:;…。！？][\"'”’»)\]]*$"
SEPARATORS = ["|", "»", "›", "•", "·", ">"]
# License and copyright lines stay: they say how a text may be used.
_STOCK = (
    r"(?i)\b(cookies?|privacy policy|terms of (use|service)|subscribe|newsletter|sign (up|in)|log ?in|click here|read more"
    r"|share (this|on)|follow us|enable javascript|lorem ipsum)\b"
)


def words(text: Column) -> Column:
    """The runs of characters other than space and the ASCII controls from tab to carriage return."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, _SPACE)).otherwise(F.array().cast("array<string>"))


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def line_fails(line: Column) -> Column:
    """Whether a line is removed. A line without words never is: it holds nothing."""
    trimmed = F.btrim(line, F.lit(SPACES))

    def fails(line_words: Column) -> Column:
        n, n_words = F.length(trimmed), F.size(line_words)
        shouts = F.size(F.filter(line_words, lambda w: w.endswith("!!")))
        menu = F.size(F.filter(line_words, lambda w: w.isin(*SEPARATORS)))
        return (
            (_count(trimmed, _SYMBOLS) > n * MAX_SYMBOLS)
            | ((shouts >= 2) & (shouts > n_words * MAX_SHOUTS))
            | ((menu >= 2) & (menu > n_words * MAX_SEPARATORS))
            | ((n_words >= MIN_WORDS) & (F.size(F.filter(line_words, lambda w, i: w == F.get(line_words, i - 1))) > n_words * MAX_STUTTER))
            | ((n_words < MIN_OPEN_WORDS) & ~trimmed.rlike(_SENTENCE_END))
            | ((n_words <= MAX_STOCK_WORDS) & trimmed.rlike(_STOCK))
        )

    return (F.length(trimmed) > 0) & _let(F.split(trimmed, _SPACE), fails)


def _repeated_words(all_words: Column, keys: Column) -> Column:
    """How many words lie in windows that are found twice or more; ``keys``: a hash for each window."""
    marked = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

    def covered(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda x, j: F.coalesce(F.get(pairs, j - 1)["k"] == x["k"], F.lit(False)) | F.coalesce(F.get(pairs, j + 1)["k"] == x["k"], F.lit(False)))
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return _let(at, lambda p: F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda s, x: s + x))

    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), _let(marked, covered)).otherwise(F.lit(0).cast("long"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _measured(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """``docs`` and, under the given names, the statistics, the verdict and the cleaned text."""
    text = F.col("text")
    w, keys, lines, left = (fresh(x) for x in ("w", "keys", "lines", "left"))
    n = F.size(w)
    out = docs.withColumn(w, words(text)).withColumn(lines, F.coalesce(F.split(text, "\n"), F.array().cast("array<string>")))
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    out = out.withColumn(keys, F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    with_word = F.filter(lines, lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    out = out.withColumns(
        {
            names["n_words"]: n.cast("long"),
            names["word_chars"]: F.length(F.array_join(w, "")).cast("long"),
            names["n_symbols"]: F.coalesce(_count(text, _SYMBOLS), F.lit(0)).cast("long"),
            names["n_dup_lines"]: _let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            names["n_repeat_words"]: _repeated_words(F.col(w), F.col(keys)),
            left: F.filter(lines, lambda x: ~line_fails(x)),
        }
    ).drop(w, keys, lines)
    out = out.withColumn(names["cleaned"], F.when(text.isNotNull(), F.array_join(left, "\n"))).drop(left)
    n, repeated = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)
    before, after = (F.coalesce(F.length(F.regexp_replace(x, _SPACE, "")), F.lit(0)) for x in (text, F.col(names["cleaned"])))
    return out.withColumns({names["base_failed"]: failed, names["lost_chars"]: (before - after).cast("long")}).withColumn(
        names["kept"], ~F.col(names["base_failed"]) & (F.col(names["lost_chars"]) <= MAX_LOST * F.col(names["word_chars"]))
    )


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", "cleaned"]


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the statistics, the verdict, the characters lost and the cleaned text of every document."""
    return _measured(docs.select("doc_id", "text"), {n: n for n in _NAMES}).select("doc_id", *_NAMES)


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with the cleaned text; n_chars, where there is one, follows it."""
    names, row = {n: fresh(n) for n in _NAMES}, fresh("row")
    # Spark pushes no filter below a row number; pushed, this one would work out every statistic once more for each use.
    measured = _measured(docs, names).withColumn(row, F.monotonically_increasing_id())
    out = measured.filter(F.col(names["kept"]) & (F.col(row) >= 0)).withColumn("text", F.col(names["cleaned"]))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
