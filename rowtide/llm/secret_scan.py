"""Secret scans with corpus-wide ownership frequency (DataFrame functions only).

Base spans come from three fixed patterns. The method adds spans of vendor formats and of random-looking tokens, and
judges every candidate value by its owners: the hash of the value is aggregated over all documents by distinct
repositories and owners. Values that at least ``example_owners`` owners and ``example_repos`` repositories share are
widely copied examples; the others are live. A random-looking token counts as a secret only if it is live. Base and
vendor spans stay in either class.

Match positions: the texts between the matches (``split``) and the matches (``regexp_extract_all``) of one pattern give
every start by a running sum, in code points. Only candidates (short rows without texts) are shuffled.

Edge cases: null text is empty; a null owner is one owner; equal texts are one repository unless a column names it; ties
of start are put in the order of the kinds; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import fresh, join_rows, row_key
from rowtide.session import broadcast_if_small, materialize

# Pattern, group that holds the value, and least length of that value, by kind.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "vendor": (r"gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{20,}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1),
    "generic": (r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[a-z0-9_-]*+[A-Z])(?=[A-Z0-9_-]*+[a-z])[A-Za-z0-9_-]{24,}", 0, 24),
}
BASE = ("assign", "access", "hex")
_SPAN = "array<struct<s:int,k:int,e:int,v:bigint>>"


def _spans(text: Column, kind: str) -> Column:
    """Spans (start, kind number, end, value hash) of one kind, in order; empty unless the pattern occurs."""
    pattern, group, least = KINDS[kind]
    number = list(KINDS).index(kind)
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.transform(
        F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g")),
        lambda x: F.struct(F.length(x["m"]).alias("n"), F.length(x["g"]).alias("gn"), F.xxhash64(x["g"]).alias("v")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["b"]
        span = F.struct(at.alias("s"), F.lit(number).alias("k"), (at + x["f"]["n"]).alias("e"), x["f"]["v"].alias("v"))
        new = F.when(x["f"].isNotNull() & (x["f"]["gn"] >= least), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct((at + F.coalesce(x["f"]["n"], F.lit(0))).alias("at"), new.cast(_SPAN).alias("out"))

    spans = F.aggregate(F.zip_with(between, found, lambda b, f: F.struct(b.alias("b"), f.alias("f"))), start, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """One slim row per document: its base and vendor spans, and its random-looking tokens outside of them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    a = docs.select(
        F.col(id_col).alias("doc_id"),
        row_key(id_col, text_col).alias("_key"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("_owner"),
        (F.xxhash64(text) if repo_col is None else F.xxhash64(F.col(repo_col))).alias("_repo"),
        text.alias("_t"),
    )
    sure = F.concat(*[_spans(F.col("_t"), k) for k in KINDS if k != "generic"])
    b = a.select("doc_id", "_key", "_owner", "_repo", sure.alias("_sure"), _spans(F.col("_t"), "generic").alias("_maybe"))
    free = F.filter("_maybe", lambda m: ~F.exists("_sure", lambda x: (x["s"] < m["e"]) & (m["s"] < x["e"])))
    return b.withColumn("_maybe", free)


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str | None = None,
    example_owners: int = 3,
    example_repos: int = 5,
) -> DataFrame:
    """One row per document with ``found``: its spans (s, k, e, v, example) in order of start, then kind."""
    rows = materialize(candidates(docs, id_col, text_col, owner_col, repo_col).withColumn("_row", F.monotonically_increasing_id()))
    each = rows.select("_row", "_owner", "_repo", F.explode(F.concat("_sure", "_maybe")).alias("c")).select("_row", "_owner", "_repo", "c.*")
    use = each.groupBy("v", "_owner", "_repo").agg(F.lit(1).alias("_one"))
    owners = use.groupBy("v", "_owner").agg(F.count("*").alias("n")).groupBy("v").agg(F.count("*").alias("owners"))
    repos = use.groupBy("v", "_repo").agg(F.lit(1).alias("n")).groupBy("v").agg(F.count("*").alias("repos"))
    shared = owners.filter(F.col("owners") >= example_owners).join(repos.filter(F.col("repos") >= example_repos), "v").select("v", F.lit(True).alias("example"))
    judged = each.join(shared, "v", "left").withColumn("example", F.coalesce("example", F.lit(False)))
    generic = list(KINDS).index("generic")
    kept = judged.filter((F.col("k") != generic) | ~F.col("example"))
    found = kept.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("s", "k", "e", "v", "example"))).alias("found"))
    return rows.select("_row", "doc_id", "_key").join(found, "_row", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<s:int,k:int,e:int,v:bigint,example:boolean>>"))).drop("_row")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of :func:`scan_secrets`."""
    base = F.filter("found", lambda x: x["k"] < len(BASE))

    def count(i: int) -> Column:
        return F.size(F.filter("found", lambda x: x["k"] == i)).cast("long")

    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda x: ~x["example"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda x: x["example"])).cast("long").alias("n_example"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """The documents with every found span replaced by ``[secret:kind]`` (live) or ``[example:kind]``.

    Overlapping spans are replaced once, from the first start to the last end of the overlap, under the name of the first.
    """
    names = F.array(*[F.lit(k) for k in KINDS])
    found = scan_secrets(docs, id_col, text_col, **options).filter(F.size("found") > 0).dropDuplicates(["doc_id", "_key"])
    joined, new = join_rows(docs, broadcast_if_small(found), id_col, text_col, "left")
    spans = F.col(new["found"])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        tag = F.concat(F.when(x["example"], F.lit("[example:")).otherwise(F.lit("[secret:")), F.get(names, x["k"]), F.lit("]"))
        out = F.concat(acc["out"], F.substr(F.col(text_col), acc["at"] + 1, x["s"] - acc["at"]), tag)
        return F.when(x["s"] >= acc["at"], F.struct(out.alias("out"), x["e"].alias("at"))).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], x["e"]).alias("at")))

    masked = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substr(F.col(text_col), acc["at"] + 1)))
    done = fresh("_masked", joined.columns)
    joined = joined.withColumn(done, F.when(spans.isNotNull(), masked).otherwise(F.col(text_col)))
    changed = {text_col: F.col(done)}
    if length_col in docs.columns:
        changed[length_col] = F.when(spans.isNotNull(), F.length(done).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return joined.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
