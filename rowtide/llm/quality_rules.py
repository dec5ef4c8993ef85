"""Quality rules from cross-document line frequency (DataFrame functions only).

Method. Lines are normalised (A-Z to a-z, digits 1-9 to 0, white space runs to one space, trimmed) and hashed. For each
host the distinct documents that hold a line are counted. A line above the limits is removed from every document of the
host; a document of which less than ``min_left`` of its words remain is depleted and rejected.

Copies must not make their own text look like a template. So equal texts count as one document, and a line goes only if
there are at least half as many families as documents that hold it. A document's family is the least of its line hashes,
each divided by the line's words, so that mostly a long line decides: edited copies of one text nearly always share it,
unrelated documents with a common footer do not. Families are taken by three hashes; one that tells documents apart is
enough, so that a footer with a very small hash isn't missed.

Pages that are mostly template take their family from a template line. So documents of a host that hold the same set of
common lines (common: held by ``max_docs`` texts) make a group, whose families are taken from the other lines only. All
common lines go from the documents of a group that has ``max_docs`` families, and at least half as many as there are texts
that hold the rarest line of the set. An edited copy lacks the lines that its edit replaced, so that edits in different
places give different sets, most of which don't reach half; a copy that has all lines of its text has no others and stays.

Edge cases: null or empty text has no words and fails the base rule; a null host is one host; lines without a word are
ignored; equal rows get equal verdicts; an empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import NON_WHITE, WHITE, join_rows, quoted, row_key, words_of
from rowtide.session import broadcast_if_small, materialize

WINDOW = 8
DIGITS = 10  # hexadecimal digits of each of the three hashes of a line that families are taken from
SYMBOLS = "#*$%&|<>"
_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789"
_TO = "abcdefghijklmnopqrstuvwxyz000000000"

# Positions whose window occurs more than once, ascending; s holds (hash, position) in order of the hash.
_REPEATED = """sort_array(array_distinct(flatten(zip_with(s, slice(s, 2, size(s)),
    (a, b) -> if(b is not null and a.h = b.h, array(a.i, b.i), cast(array() as array<int>))))))"""


def _repeat_words() -> str:
    """SQL: words covered by windows that occur twice or more; arrays are bound once by transform(array(x), ...)."""
    covered = f"""aggregate(zip_with(p, slice(p, 2, size(p)), (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW}))), 0, (x, y) -> x + y)"""
    return f"""case when size(_windows) = size(array_distinct(_windows)) then 0
        else transform(transform(array(sort_array(transform(_windows, (h, i) -> named_struct('h', h, 'i', i)))), s -> {_REPEATED}),
                       p -> {covered})[0] end"""


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Row-local measures of every document: base counts, and its normalised lines as (64-bit hash, words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    a = docs.select(
        F.col(id_col).alias("doc_id"),
        row_key(id_col, text_col).alias("_key"),
        F.xxhash64(text).alias("_text"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("_host"),
        text.alias("_t"),
    )
    b = a.withColumns({"_words": F.transform(words_of(F.col("_t")), lambda w: F.xxhash64(w)), "_lines": F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(NON_WHITE))})
    c = b.withColumn(
        "_windows",
        F.expr(f"case when size(_words) >= {WINDOW} then transform(sequence(1, size(_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW}))) else cast(array() as array<bigint>) end"),
    )
    normal = F.transform("_lines", lambda x: F.translate(F.trim(F.regexp_replace(x, WHITE, " ")), _FROM, _TO))

    def bits(digest: Column, at: int) -> Column:
        return F.conv(F.substring(digest, at, DIGITS), 16, 10).cast("long")

    hashed = F.transform(F.transform(normal, lambda x: F.struct(F.xxhash64(x).alias("l"), F.md5(x.cast("binary")).alias("m"), (F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("w"))), lambda x: F.struct(x["l"].alias("l"), bits(x["m"], 1).alias("h"), bits(x["m"], 1 + DIGITS).alias("i"), bits(x["m"], 1 + 2 * DIGITS).alias("j"), x["w"].alias("w")))
    c = c.withColumn("_hashed", hashed).withColumn("_families", F.expr("array(array_min(transform(_hashed, x -> x.h div x.w)), array_min(transform(_hashed, x -> x.i div x.w)), array_min(transform(_hashed, x -> x.j div x.w)))"))
    return c.select(
        "doc_id",
        "_key",
        "_text",
        "_host",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_repeat_words()).cast("long").alias("n_repeat_words"),
        "_families",
        F.transform("_hashed", lambda x: F.struct(x["l"].alias("l"), x["w"].alias("w"))).alias("_hashed"),
    )


def _templates(rows: DataFrame, common: DataFrame, max_docs: int) -> DataFrame:
    """``_row`` of the documents whose common lines many others hold as well, with unrelated other lines."""
    lines = rows.select("_row", "_host", F.explode(F.array_distinct("_hashed")).alias("l")).select("_row", "_host", F.col("l.l").alias("_line"), F.col("l.w").alias("_w"))
    shared = F.col("_docs").isNotNull()
    others = [F.min(F.when(~shared, F.shiftrightunsigned(F.xxhash64("_line", F.lit(k)), 24) / F.col("_w"))) for k in range(3)]
    sets = lines.join(common, ["_host", "_line"], "left").groupBy("_row", "_host").agg(
        F.bit_xor(F.when(shared, F.xxhash64("_line"))).alias("_set"), F.min("_docs").alias("_docs"), F.array(*[F.coalesce(x, F.lit(-1.0)) for x in others]).alias("_others")
    )
    sets = materialize(sets.filter(F.col("_docs").isNotNull()))
    families = sets.select("_host", "_set", "_docs", F.posexplode("_others").alias("_k", "_family"))
    groups = (
        families.groupBy("_host", "_set", "_docs", "_k", "_family").agg(F.lit(1).alias("_one"))
        .groupBy("_host", "_set", "_docs", "_k").agg(F.count("*").alias("_n"))
        .filter((F.col("_n") >= max_docs) & (2 * F.col("_n") >= F.col("_docs")))
    )
    return sets.join(groups, ["_host", "_set", "_docs"], "left_semi").filter(~F.forall("_others", lambda x: x < 0)).select("_row")


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = 10,
    min_left: float = 0.2,
    min_words: int = 20,
    max_repeat_pct: int = 30,
) -> DataFrame:
    """One row per document: base counts, words in removed lines, ``base_failed`` and ``kept``.

    ``max_docs``: a line is removed in a host from so many distinct documents on. ``min_left``: share of its words that
    a document keeps at least. The measures are written once (slim rows, no text) and read by all later steps.
    """
    rows = materialize(measure(docs, id_col, text_col, host_col).withColumn("_row", F.monotonically_increasing_id()))
    lines = rows.select("_row", "_text", "_host", "_families", F.explode("_hashed").alias("l")).select("_row", "_text", "_host", "_families", F.col("l.l").alias("_line"), F.col("l.w").alias("_w"))
    held = lines.groupBy("_host", "_line", "_text").agg(F.lit(1).alias("_one"))
    common = broadcast_if_small(held.groupBy("_host", "_line").agg(F.count("*").alias("_docs")).filter(F.col("_docs") >= max_docs))
    family = lines.join(common, ["_host", "_line"], "left_semi").select("_host", "_line", "_text", F.posexplode("_families").alias("_k", "_family"))
    frequent = (
        family.groupBy("_host", "_line", "_k", "_family", "_text").agg(F.lit(1).alias("_one"))
        .groupBy("_host", "_line", "_k", "_family").agg(F.count("*").alias("_docs"))
        .groupBy("_host", "_line", "_k").agg(F.sum("_docs").alias("_docs"), F.count("*").alias("_n"))
        .filter((F.col("_n") >= max_docs) & (2 * F.col("_n") >= F.col("_docs")))
        .select("_host", "_line").distinct()
    )
    frequent = broadcast_if_small(frequent)
    gone = lines.join(frequent, ["_host", "_line"], "left_semi").select("_row", "_w")
    pages = lines.join(broadcast_if_small(_templates(rows, common, max_docs)), "_row", "left_semi").join(common, ["_host", "_line"], "left_semi")
    removed = gone.unionByName(pages.join(frequent, ["_host", "_line"], "left_anti").select("_row", "_w")).groupBy("_row").agg(F.sum("_w").cast("long").alias("_gone"))
    gone = F.coalesce("_gone", F.lit(0).cast("long"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    return (
        rows.drop("_hashed", "_families", "_text", "_host")
        .join(removed, "_row", "left")
        .withColumn("n_removed_words", gone)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_removed_words") >= F.lit(min_left) * F.col("n_words")))
        .select("doc_id", "_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    bad = quality_rules(docs, id_col, text_col, **options).filter(~F.col("kept")).select("doc_id", "_key").distinct()
    return join_rows(docs, broadcast_if_small(bad), id_col, text_col, "left_anti")[0].select(*quoted(docs.columns))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, host, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), win AS (
  SELECT rid, p, list_aggregate(list_slice(ws, p, p + 7), 'string_agg', ' ') AS s
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS p FROM w WHERE len(ws) >= 8)
), twice AS (
  SELECT rid, p, lead(p) OVER (PARTITION BY rid ORDER BY p) AS q
  FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, s) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT rid, sum(least(8, coalesce(q - p, 8))) AS n FROM twice GROUP BY rid
), ln AS (
  SELECT rid, host, t, translate(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'), ' '),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS l
  FROM (SELECT rid, host, t, unnest(ls) AS x FROM w)
), lw AS (
  SELECT rid, host, t, l, md5(l) AS m, length(l) - length(replace(l, ' ', '')) + 1 AS n FROM ln
), lh AS (
  SELECT rid, host, t, l, n, min(('0x' || substr(m, 1, 10))::BIGINT // n) OVER (PARTITION BY rid) AS fa,
         min(('0x' || substr(m, 11, 10))::BIGINT // n) OVER (PARTITION BY rid) AS fb,
         min(('0x' || substr(m, 21, 10))::BIGINT // n) OVER (PARTITION BY rid) AS fc FROM lw
), freq AS (
  SELECT host, l FROM lh GROUP BY host, l
  HAVING greatest(count(DISTINCT fa), count(DISTINCT fb), count(DISTINCT fc)) >= 10
     AND 2 * greatest(count(DISTINCT fa), count(DISTINCT fb), count(DISTINCT fc)) >= count(DISTINCT t)
), gone AS (
  SELECT rid, sum(n) AS n FROM lh SEMI JOIN freq USING (host, l) GROUP BY rid
), m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(gone.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid)
), f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_words - n_removed_words >= 0.2 * n_words AS kept FROM f
"""
