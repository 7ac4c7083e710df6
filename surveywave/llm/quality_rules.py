"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each text is measured once.  The measures of all documents go into quantile
sketches, one per language, source and rule, and each sketch gives the fences
between which its documents are usual.  No cutoff of a measure is fixed.

A sketch is a table of counts over the buckets of a log-linear scale (as in an
HDR histogram; a bucket is at most 1/32 of its values wide).  Counts of equal
buckets add up, so sketches merge exactly, in any order and over any
partitioning: the sketch of a language is the sum of those of its sources, that
of the corpus the sum of the languages'.  A group with few documents takes the
fences of its language, and a language with few those of the corpus; below that
no fence applies.

Fences are far-out fences around the quartiles (Tukey): a document fails a rule
where its measure lies more than `reach` quartile distances beyond a quartile.
A distance counts as `slack` of its rule at least, so that a measure which is 0
in most documents does not turn a single symbol or line into a failure.

All of it is DataFrame functions: whole texts are measured inside one projection
(windows of words are hashed and sorted in the row), only integers move, counts
are combined before the shuffle, and the fences (a few rows a group) are joined
to the measured rows.

Edge cases.  NULL texts and texts without a word have 0 words and fail the base
rules; they are in no sketch.  NULL languages and sources are groups of their
own.  Very long texts are read whole; the work is n log n in their words.  Ties
and repeated rows count once a row, and each row gets its own result.  An empty
table gives an empty result.  Columns of the input with the names of measures do
not clash: only those named in `carry` are read, and they come first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, Scratch

SYMBOLS = "[#*$%&|<>]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


@dataclass(frozen=True)
class Rule:
    """An integer measure with the fences that apply to it."""

    name: str
    top: str          # the measure is scale * top / bottom, rounded down
    bottom: str
    scale: int
    slack: int        # least distance between quartiles, in units of the measure
    low: bool = False  # whether too low a measure fails too

    def value(self) -> Column:
        part = F.expr(f"({self.scale} * {self.top}) div {self.bottom}")
        return F.when(F.col(self.bottom) > 0, part)


RULES = (
    Rule("word_length", "word_chars", "n_words", 1000, 250, low=True),
    Rule("symbol_share", "n_symbols", "word_chars", 10_000, 100),
    Rule("dup_line_share", "n_dup_lines", "n_lines", 10_000, 1000),
    Rule("repeat_share", "n_repeat_words", "n_words", 10_000, 600),
)


# --- measures of a text --------------------------------------------------------

def _bound(value: Column, body) -> Column:
    """body(value) with value computed once, although body names it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pairs(hashes: Column, step: int) -> Column:
    """The hash of every element and the one `step` places on."""
    size = F.size(hashes) - step
    return F.zip_with(F.slice(hashes, 1, F.greatest(size, F.lit(0))), F.slice(hashes, step + 1, F.greatest(size, F.lit(0))),
                      lambda a, b: F.xxhash64(a, b))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash is there at least twice."""
    def repeated(s: Column) -> Column:
        # s: (hash, place), sorted; neighbours with an equal hash are repeated windows
        last = F.size(s) - 1
        hit = F.filter(s, lambda x, i: ((i > 0) & (x["h"] == s[F.greatest(i - 1, F.lit(0))]["h"]))
                       | ((i < last) & (x["h"] == s[F.least(i + 1, last)]["h"])))
        places = F.sort_array(F.transform(hit, lambda x: x["p"]))
        return F.aggregate(places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
                           lambda acc, p: F.struct((acc["n"] + F.least(p - acc["last"], F.lit(WINDOW))).alias("n"), p.alias("last")),
                           lambda acc: acc["n"])

    numbered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return (F.when(F.size(hashes) < 2, F.lit(0).cast("long"))
            .when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long"))
            .otherwise(_bound(numbered, repeated)))


def measures(docs: DataFrame, text_col: str = "text", carry: Sequence[str] = ("doc_id", "lang", "source")) -> DataFrame:
    """The carried columns and the counts of BASE, as longs, of each whole text.

    n_lines counts the lines that hold a word.  Windows are compared by the
    64-bit hash of their words: two different windows of one text share it with
    probability n²/2⁶⁵ (1e-11 for 20,000 words).
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_c"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_t"))
    rows = rows.select("_c", "_t", F.array_remove(F.split("_t", f"{SPACE}+"), "").alias("_w"),
                       F.filter(F.split("_t", "\n"), lambda line: line.rlike(WORD)).alias("_l"))

    def windows(words: Column) -> Column:
        two = F.transform(words, lambda w: F.xxhash64(w))
        return _bound(_bound(_bound(two, lambda h: _pairs(h, 1)), lambda h: _pairs(h, 2)), lambda h: _pairs(h, 4))

    rows = rows.withColumn("_h", windows(F.col("_w")))
    as_long = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, "")),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": _covered(F.col("_h")),
        "n_lines": F.size("_l"),
    }
    return rows.select("_c.*", *[c.cast("long").alias(name) for name, c in as_long.items()])


def base_failed() -> Column:
    """The rules that no corpus changes: too few words, or mostly repetition."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


# --- sketches ------------------------------------------------------------------

def bucket_of(value: str) -> Column:
    """The bucket of a value >= 0 on the log-linear scale, in integers only."""
    shift = f"(length(bin({value})) - 6)"
    return F.expr(f"CASE WHEN {value} < 64 THEN {value} ELSE 32 * {shift} + shiftright({value}, {shift}) END")


def _edge(bucket: str, upper: bool) -> Column:
    """The least value of a bucket, or the greatest."""
    shift = f"cast({bucket} div 32 - 1 as int)"
    low = f"CASE WHEN {bucket} < 64 THEN {bucket} ELSE shiftleft({bucket} - 32 * {shift}, {shift}) END"
    return F.expr(f"{low} + CASE WHEN {bucket} < 64 THEN 0 ELSE shiftleft(1L, {shift}) - 1 END" if upper else low)


def sketch(measured: DataFrame, keys: Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """The sketches of every group and rule: keys, rule, bucket, n."""
    values = F.array(*[F.struct(F.lit(r.name).alias("rule"), r.value().alias("value")) for r in rules])
    rows = measured.select(*keys, F.explode(values).alias("v")).select(*keys, "v.rule", "v.value").where("value IS NOT NULL")
    return rows.withColumn("bucket", bucket_of("value")).groupBy(*keys, "rule", "bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of the groups that `keys` leave, by adding counts."""
    return sketches.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, rule, n_docs, q1 and q3: the edges of the buckets that hold the
    quartiles, the low edge for the lower one and the high edge for the upper.
    A window holds the buckets of one sketch, under 2,000 for any input."""
    group = Window.partitionBy(*keys, "rule")
    ranked = sketches.withColumns({"upto": F.sum("n").over(group.orderBy("bucket")), "n_docs": F.sum("n").over(group)})
    return ranked.groupBy(*keys, "rule").agg(
        F.max("n_docs").alias("n_docs"),
        F.min(F.when(F.expr("4 * upto >= n_docs"), _edge("bucket", False))).alias("q1"),
        F.min(F.when(F.expr("4 * upto >= 3 * n_docs"), _edge("bucket", True))).alias("q3"))


def fences(quartile_rows: DataFrame, keys: Sequence[str], reach: int, least_docs: int, rules: Sequence[Rule] = RULES) -> DataFrame:
    """A row a group: its keys, and low_<rule> and high_<rule> where the group
    has least_docs documents with the measure (else NULL)."""
    enough = F.col("n_docs") >= least_docs
    out = []
    for r in rules:
        here = enough & (F.col("rule") == r.name)
        width = F.greatest(F.col("q3") - F.col("q1"), F.lit(r.slack)) * reach
        out.append(F.max(F.when(here, F.col("q3") + width)).alias(f"high_{r.name}"))
        if r.low:
            out.append(F.max(F.when(here, F.col("q1") - width)).alias(f"low_{r.name}"))
    return quartile_rows.groupBy(*keys).agg(*out)


def group_fences(measured: DataFrame, scratch: Scratch, reach: int = 4, least_docs: int = 100, rules: Sequence[Rule] = RULES,
                 lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source and the fences that apply there: the group's own, else its
    language's, else the corpus's; one row for each language and source."""
    named = measured.withColumns({"lang": F.col(lang_col), "source": F.col(source_col)})
    finest = scratch.table(sketch(named, ["lang", "source"], rules), "sketches")
    by_lang = merge(finest, ["lang"])
    levels = [(["lang", "source"], finest), (["lang"], by_lang), ([], merge(by_lang, []))]
    own, of_lang, of_all = [fences(quartiles(s, keys), keys, reach, least_docs, rules) for keys, s in levels]
    names = [c for c in own.columns if c not in ("lang", "source")]
    rows = own.alias("o").join(of_lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")), "left")
    corpus = of_all.first()  # one row: it is grouped by nothing
    return scratch.table(rows.select("o.lang", "o.source", *[
        F.coalesce(F.col(f"o.{c}"), F.col(f"l.{c}"), F.lit(corpus[c]).cast("long")).alias(c) for c in names]), "fences")


# --- the filter ----------------------------------------------------------------

def judge(measured: DataFrame, limits: DataFrame, rules: Sequence[Rule] = RULES,
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """measured with base_failed, failed (names of the adaptive rules that a row
    fails, in the order of the rules) and kept."""
    fence_cols = [c for c in limits.columns if c not in ("lang", "source")]
    right = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.struct(*fence_cols).alias("_f"))
    rows = measured.join(right, F.col(lang_col).eqNullSafe(F.col("_lang")) & F.col(source_col).eqNullSafe(F.col("_source")), "left")
    tests = []
    for r in rules:
        beyond = r.value() > F.col(f"_f.high_{r.name}")
        if r.low:
            beyond = beyond | (r.value() < F.col(f"_f.low_{r.name}"))
        tests.append(F.when(beyond, F.lit(r.name)))
    return rows.withColumns({"base_failed": base_failed(), "failed": F.array_compact(F.array(*tests))}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop("_lang", "_source", "_f")


def quality_rules(docs: DataFrame, scratch: Scratch, reach: int = 4, least_docs: int = 100, rules: Sequence[Rule] = RULES,
                  id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: id, language, source, the counts, base_failed,
    failed and kept.  The measured rows are written once: the sketches and the
    filter read them, the texts are read a single time."""
    carry = list(dict.fromkeys([id_col, lang_col, source_col]))
    measured = scratch.table(measures(docs, text_col, carry), "measured")
    return judge(measured, group_fences(measured, scratch, reach, least_docs, rules, lang_col, source_col), rules, lang_col, source_col)
