"""N-gram Jaccard self-join: rare-first prefixes with length, positional and suffix filters; components of the links.

1. Count n-grams over all documents. Every task sends its n-gram hashes, cut to ``COUNT_BITS`` bits, as sorted packed
   differences; the reducers count them. The ``HEAVY`` most frequent buckets are known to every task (a fixed size);
   all other n-grams are rarer than these. "Rarer first, then by hash" is the order of the prefixes. The join is exact
   for any order; the counts only make the lists short.
2. Every document gives its number of n-grams, a set signature and its prefix. Documents with equal sets are one class
   and are searched once.
3. Prefix n-grams are grouped. Heavy ones are split over chunks of about ``CHUNK`` documents. A list of up to ``SHORT``
   classes gives all its pairs that pass the length and positional filter; a longer one pairs its classes with
   ``CENTRES`` centres.
4. Each distinct pair is verified once on whole texts (suffix filter, then the exact intersection).
5. Long lists: pairs whose classes are still in different components are verified too. So no link between components
   is lost, and groups of thousands of copies never give all their pairs.

Edge cases: null text or text without words has an empty set and links with nothing; fewer words than ``n`` are one
n-gram; equal rows are one class; a null id is never the smallest; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import join_rows, quoted, release_memory, releasing, row_key
from rowtide.llm.links import components
from rowtide.session import broadcast_if_small, materialize

COUNT_BITS = 36
HEAVY = 400_000
LEAST_HEAVY = 8
CHUNK = 4096
SHORT = 32
CENTRES = 12
CELLS = 256
BLOCK = 1 << 17
SLICE_BYTES = 500_000
FLUSH = 4_000_000  # n-grams that a counting task holds
PART_BYTES = 32_000_000  # of text per part of the counts

_cells = np.arange(CELLS, dtype=np.uint64) * np.uint64((1 << 64) // CELLS)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LETTERS = 1 << 6  # places of a word whose (place, byte) values are looked up
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_weights = _mix(np.arange(1, 65, dtype=np.uint64) * _GOLD) | np.uint64(1)
_letters = _mix((np.arange((LETTERS + 1) * 256, dtype=np.uint64) + np.uint64(1)) * _GOLD)


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word: the mixed sum of a mixed value per (place in the word, byte)."""
    place = np.arange(len(raw), dtype=np.int32) - np.repeat(starts.astype(np.int32), np.diff(np.r_[starts, len(raw)]))
    values = _letters[(np.minimum(place, LETTERS) << 8) | raw]
    far = np.flatnonzero(place >= LETTERS)
    if len(far):
        values[far] = _mix((place[far].astype(np.uint64) * np.uint64(256) + raw[far] + np.uint64(1)) * _GOLD)
    values[ends[:-1]] = 0  # the spaces
    return _mix(np.add.reduceat(values, starts) + (ends - starts).astype(np.uint64) * _GOLD)


def ngrams_of(texts: Iterable[str | None], n: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word n-grams (words by ASCII white space, A-Z lowered).

    Hashes of the words are weighted by their place in the n-gram, summed and mixed again: there is no algebra between
    different texts that would make their sums meet, other than by chance. Texts go through in slices of ``SLICE_BYTES``.
    """
    held, size = [], 0
    for text in texts:
        held.append(b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split()))
        size += len(held[-1])
        if size > SLICE_BYTES:
            yield from _ngrams(held, n)
            held, size = [], 0
    yield from _ngrams(held, n)


def _ngrams(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    words = np.array([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
    raw = np.frombuffer(b" ".join(t for t in texts if t), np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(raw)]
    parts = [np.empty(0, np.uint64)]
    for i in range(0, len(starts) if len(raw) else 0, BLOCK):  # bounded working memory for very long texts
        s, e = starts[i : i + BLOCK], ends[i : i + BLOCK]
        parts.append(_word_hashes(raw[s[0] : e[-1]], s - s[0], e - s[0]))
    hashes = np.concatenate(parts)

    def combined(h: np.ndarray, width: int) -> np.ndarray:
        count = len(h) - width + 1
        total = np.full(max(count, 0), width, np.uint64)
        for j in range(width if count > 0 else 0):
            total += h[j : j + count] * _weights[j % len(_weights)]
        return _mix(total)

    whole = combined(hashes, n)  # those that reach into the next text aren't used
    at = 0
    for w in words.tolist():
        yield np.unique(whole[at : at + w - n + 1]) if w >= n else combined(hashes[at : at + w], w) if w else np.empty(0, np.uint64)
        at += w


def ngrams(text: str | None, n: int = 5) -> np.ndarray:
    """:func:`ngrams_of` one text."""
    return next(iter(ngrams_of([text], n)))


def needed(size: int, pct: int) -> int:
    return (pct * size + 99) // 100


def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers as byte planes of their differences; the shuffle's compression removes the empty planes."""
    steps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _count_map(n: int, part_bits: int) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            values = np.sort(np.concatenate(held)) >> np.uint64(64 - COUNT_BITS)
            held.clear()
            cuts = np.searchsorted(values, np.arange((1 << part_bits) + 1, dtype=np.uint64) << np.uint64(COUNT_BITS - part_bits))
            parts = [(p, _pack(values[a:b])) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            return pd.DataFrame(parts, columns=["part", "blob"])

        size = 0
        for frame in frames:
            for grams in ngrams_of(frame["text"], n):
                held.append(grams)
                size += len(grams)
                if size > FLUSH:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return run


def _count_reduce(frame: pd.DataFrame) -> pd.DataFrame:
    values = np.sort(np.concatenate([_unpack(b) for b in frame["blob"]]))
    at = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    count = np.diff(np.r_[at, len(values)])
    top = count >= LEAST_HEAVY
    return pd.DataFrame({"bucket": values[at[top]].astype(np.int64), "df": count[top].astype(np.int64)})


def heavy_ngrams(docs: DataFrame, text_col: str, n: int) -> DataFrame:
    """The ``HEAVY`` most frequent n-gram buckets with their counts over all documents."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    part_bits = max(6, (total // PART_BYTES).bit_length())  # the parts grow with the table
    packed = docs.select(F.col(text_col).alias("text")).mapInPandas(releasing(_count_map(n, part_bits)), "part int, blob binary")
    counts = packed.groupBy("part").applyInPandas(_count_reduce, "bucket long, df long")
    return counts.orderBy(F.desc("df"), "bucket").limit(HEAVY)


def _sketch(h: np.ndarray) -> bytes | None:
    """Counts of a set over ``CELLS`` equal ranges of hashes; None where a count is too large."""
    count = np.diff(np.searchsorted(h, _cells), append=0)
    count[-1] = len(h) - np.searchsorted(h, _cells[-1])
    return count.astype(np.uint16).tobytes() if count.max() < 65536 else None


def _signature(heavy, n: int, pct: int) -> Callable:
    @F.pandas_udf("n long, sign long, prefix array<long>, chunk array<int>, sketch binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bucket, df = heavy.value
        seen = np.zeros(1 << 22, bool)
        seen[bucket & np.uint64((1 << 22) - 1)] = True
        for texts in batches:
            sizes, signs, prefixes, chunks, sketches = [], [], [], [], []
            for h in ngrams_of(texts, n):
                sizes.append(len(h))
                sketches.append(_sketch(h))
                if not len(h):
                    signs.append(0)
                    prefixes.append([])
                    chunks.append([])
                    continue
                sign = _mix(np.array([h.sum() ^ np.uint64(len(h))], np.uint64))
                signs.append(int(sign.view(np.int64)[0]))
                want = len(h) - needed(len(h), pct) + 1
                b = h >> np.uint64(64 - COUNT_BITS)
                maybe = np.flatnonzero(seen[b & np.uint64((1 << 22) - 1)])
                at = np.minimum(np.searchsorted(bucket, b[maybe]), max(len(bucket) - 1, 0))
                hit = bucket[at] == b[maybe] if len(bucket) else np.zeros(0, bool)
                weight = np.zeros(len(h), np.int64)
                weight[maybe[hit]] = df[at[hit]]
                light = np.flatnonzero(weight == 0)[:want]
                if len(light) < want:
                    rest = np.flatnonzero(weight)
                    light = np.r_[light, rest[np.argsort(weight[rest], kind="stable")][: want - len(light)]]
                prefixes.append(h[light].view(np.int64))
                w = weight[light]
                split = w > CHUNK
                chunks.append((np.where(split, sign[0] % np.maximum(-(-w // CHUNK), 1).astype(np.uint64), 0) * 2 + split).astype(np.int32))
            yield pd.DataFrame({"n": pd.Series(sizes, dtype="int64"), "sign": pd.Series(signs, dtype="int64"), "prefix": prefixes, "chunk": chunks, "sketch": sketches})
        release_memory()

    return run


def _allowed(na, ia, nb, ib, pct: int):
    """Length and positional filter for a shared n-gram at positions ia and ib of ordered sets of sizes na and nb."""
    least = -(-pct * (na + nb) // (100 + pct))
    return (100 * np.minimum(na, nb) >= pct * np.maximum(na, nb)) & (1 + np.minimum(na - ia - 1, nb - ib - 1) >= least)


def _pairs_of(g, chunk, rep, n, pos, pct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (a, b) of the lists of one partition, and which rows belong to lists that aren't done with them."""
    order = np.lexsort((rep, chunk, g))
    g, chunk, rep, n, pos = g[order], chunk[order], rep[order], n[order], pos[order]
    first = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (chunk[1:] != chunk[:-1])])
    each = np.diff(np.r_[first, len(g)])
    size, head = np.repeat(each, each), np.repeat(first, each)
    done, a_all, b_all = size <= SHORT, [], []
    for d in range(1, SHORT):
        i = np.flatnonzero((size[:-d] > d) & (head[:-d] == head[d:]) & done[:-d]) if len(g) > d else []
        if not len(i):
            break
        ok = i[_allowed(n[i], pos[i], n[i + d], pos[i + d], pct)]
        a_all.append(rep[ok])
        b_all.append(rep[ok + d])
    # The centres of a long list are the classes with the least hashes. Lists of one group of copies hold nearly the same
    # classes, so they share most centres, and the pairs grow with the group's size.
    rank = np.empty(len(g), np.int64)
    rank[np.lexsort((_mix(rep.astype(np.uint64)), head))] = np.arange(len(g)) - head
    centre = np.full((len(first), CENTRES), -1)
    near = np.flatnonzero(~done & (rank < CENTRES))
    centre[np.searchsorted(first, head[near]), rank[near]] = near
    for c in centre.T:
        c = np.repeat(c, each)
        i = np.flatnonzero(~done & ((rank >= CENTRES) | (rank > rank[c])))
        ok = i[_allowed(n[i], pos[i], n[c[i]], pos[c[i]], pct)]
        a_all.append(rep[ok])
        b_all.append(rep[c[ok]])
    a, b = np.concatenate(a_all), np.concatenate(b_all)
    left = np.flatnonzero(~done | ((chunk & 1) == 1))
    return a, b, order[left]


def _list_map(pct: int) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [f.to_numpy(np.int64) for f in frames]
        if not rows or not sum(map(len, rows)):
            return
        g, chunk, rep, n, pos = np.concatenate(rows).T
        del rows
        a, b, left = _pairs_of(g, chunk, rep, n, pos, pct)
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        both = np.unique(np.stack([lo, hi], 1), axis=0) if len(lo) else np.empty((0, 2), np.int64)
        yield pd.DataFrame({"kind": 0, "a": both[:, 0], "b": both[:, 1], "chunk": 0, "n": 0, "pos": 0})
        yield pd.DataFrame({"kind": 1, "a": g[left], "b": rep[left], "chunk": chunk[left], "n": n[left], "pos": pos[left]})

    return run


def _verify_map(n: int, pct: int) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.arange(65, dtype=np.uint64) << np.uint64(58)
        cells[64] = np.uint64((1 << 64) - 1)
        kept: dict[int, np.ndarray] = {}
        for frame in frames:
            u, v = [], []
            for a, b, ta, tb in zip(frame["a"], frame["b"], frame["ta"], frame["tb"], strict=True):
                if a not in kept:
                    kept.clear()  # rows of one document mostly stand together
                    kept[a] = ngrams(ta, n)
                x, y = kept[a], ngrams(tb, n)
                both = len(x) + len(y)
                apart = np.abs(np.diff(np.searchsorted(x, cells)) - np.diff(np.searchsorted(y, cells))).sum()
                if 100 * (both - apart + 2) < 2 * (pct * both // (100 + pct)) * 100:  # suffix filter; 2 for the open last cell
                    continue
                same = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * same >= pct * (both - same):
                    u.append(a)
                    v.append(b)
            yield pd.DataFrame({"u": pd.Series(u, dtype="int64"), "v": pd.Series(v, dtype="int64")})

    return run


def _verified(pairs: DataFrame, docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, n: int, pct: int) -> DataFrame:
    """The pairs (a, b) of class representatives whose whole texts reach the similarity, as links (u, v)."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("_row")).distinct()
    wanted = broadcast_if_small(rows.select("_row", "doc_id", "_key").join(ends, "_row", "left_semi"))
    keyed = docs.select(F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_k"), F.col(text_col).alias("text"))
    texts = keyed.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_k") == F.col("_key"))).select("_row", "text").dropDuplicates(["_row"])
    one = pairs.join(texts.select(F.col("_row").alias("b"), F.col("text").alias("tb")), "b")
    two = one.join(texts.select(F.col("_row").alias("a"), F.col("text").alias("ta")), "a")
    return two.select("a", "b", "ta", "tb").mapInPandas(releasing(_verify_map(n, pct)), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, pct: int = 80) -> DataFrame:
    """One row per document: ``doc_id, _key, n_shingles, component_id, keeper``.

    Two documents link when 100 * |intersection| >= pct * |union| of their n-gram sets. ``component_id`` is the smallest
    id that links reach. ``keeper`` marks one row of every component.
    """
    spark = docs.sparkSession
    top = heavy_ngrams(docs, text_col, n).toPandas().sort_values("bucket")
    heavy = spark.sparkContext.broadcast((top["bucket"].to_numpy(np.uint64), top["df"].to_numpy(np.int64)))
    signed = _signature(heavy, n, pct)(F.col(text_col)).alias("s")
    keyed = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("_key"), signed)
    rows = materialize(keyed.select("_row", "doc_id", "_key", "s.*"))
    classes = rows.filter(F.col("n") > 0).groupBy("sign", "n").agg(F.min("_row").alias("rep"), F.first(F.struct("prefix", "chunk")).alias("p"))
    postings = classes.select("rep", "n", F.posexplode(F.arrays_zip("p.prefix", "p.chunk")).alias("pos", "x")).select(F.col("x.prefix").alias("g"), F.col("x.chunk").alias("chunk"), "rep", "n", F.col("pos").cast("long").alias("pos"))
    lists = materialize(postings.repartition("g", "chunk").mapInPandas(releasing(_list_map(pct)), "kind int, a long, b long, chunk long, n long, pos long"))
    pairs = lists.filter("kind = 0").select("a", "b").distinct()
    links = materialize(_verified(pairs, docs, rows, id_col, text_col, n, pct))
    labels = components(links)
    long = lists.filter("kind = 1").select(F.col("a").alias("g"), F.col("b").alias("rep"), "chunk", "n", "pos")
    more = _across(long, labels, rows, pairs, pct)
    if more is not None:
        links = materialize(links.unionByName(_verified(more, docs, rows, id_col, text_col, n, pct)))
        labels = components(links)
    reps = rows.filter(F.col("n") > 0).groupBy("sign", "n").agg(F.min("_row").alias("rep"))
    slim = rows.select("_row", "doc_id", "_key", "n", "sign")
    labelled = (
        slim.join(reps.withColumnRenamed("n", "n2").withColumnRenamed("sign", "s2"), (F.col("sign") == F.col("s2")) & (F.col("n") == F.col("n2")), "left")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select("_row", "doc_id", "_key", "n", F.coalesce("label", "rep", F.col("_row")).alias("label"))
    )
    labelled = materialize(labelled)
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_row")).alias("k"))
    return labelled.join(least.select("label", "component_id", F.col("k._row").alias("_keep")), "label").select("doc_id", "_key", F.col("n").alias("n_shingles"), "component_id", (F.col("_row") == F.col("_keep")).alias("keeper"))


def _across_map(pct: int) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(frames)
        if not sum(map(len, parts)):
            return
        f = pd.concat(parts).sort_values(["g", "chunk", "sent"], kind="stable")
        f = f.drop_duplicates(["g", "chunk", "sent", "rep"])
        del parts
        g, chunk, sent, rep, n, pos, label, major = (f[c].to_numpy(np.int64) for c in ("g", "chunk", "sent", "rep", "n", "pos", "label", "major"))
        full = np.full(CELLS, 65535, np.uint16).tobytes()
        sketch = np.frombuffer(b"".join(full if x is None else x for x in f["sketch"]), np.uint16).reshape(-1, CELLS)
        del f
        first = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (chunk[1:] != chunk[:-1])])
        found: set[tuple[int, int]] = set()
        for lo, hi in zip(first, np.r_[first[1:], len(g)], strict=True):
            cut = lo + int(np.searchsorted(sent[lo:hi], 1))
            m = np.arange(lo, cut)
            for o in range(cut, hi):
                near = m[(label[m] != label[o]) & ((label[m] == major[m]) | (rep[o] < rep[m])) & _allowed(n[m], pos[m], n[o], pos[o], pct)]
                least = -(-pct * (n[near] + n[o]) // (100 + pct))
                near = near[np.minimum(sketch[near], sketch[o]).sum(1, dtype=np.int64) >= least]
                found.update((min(a, rep[o]), max(a, rep[o])) for a in rep[near].tolist())
        yield pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return run


def _across(long: DataFrame, labels: DataFrame, rows: DataFrame, tried: DataFrame, pct: int) -> DataFrame | None:
    """Pairs of long lists whose ends are in different components and that weren't tried; None if there are none.

    Per n-gram the largest component is left as it is: every other member meets all members outside of its own
    component, chunk by chunk. Pairs that the length, positional or suffix filter refuses are never rows; the suffix
    filter here is the overlap that the two sets' counts over ranges of hashes still allow.
    """
    known = long.join(labels, F.col("rep") == F.col("node"), "left").select("g", "chunk", "rep", "n", "pos", F.coalesce("label", "rep").alias("label"))
    mixed = known.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("g")
    members = materialize(known.join(mixed, "g", "left_semi"))
    if members.isEmpty():
        return None
    count = members.groupBy("g", "label").agg(F.count("*").alias("c"))
    major = count.groupBy("g").agg(F.max_by("label", F.struct("c", "label")).alias("major"))
    sketches = rows.select(F.col("_row").alias("rep"), "sketch")
    members = members.join(major, "g").join(sketches, "rep")
    columns = ["g", "chunk", "rep", "n", "pos", "label", "major", "sketch"]
    places = members.select("g", "chunk").distinct()
    outside = members.filter("label <> major").drop("chunk").join(places, "g")
    both = members.select(*columns, F.lit(0).alias("sent")).unionByName(outside.select(*columns, F.lit(1).alias("sent")))
    pairs = both.repartition("g", "chunk").mapInPandas(releasing(_across_map(pct)), "a long, b long").distinct()
    return materialize(pairs.join(tried, ["a", "b"], "left_anti"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component (the smallest id), with all its columns; of equal rows one stays."""
    found = near_duplicates(docs, id_col, text_col, **options)
    gone = found.filter("n_shingles > 0").groupBy("doc_id", "_key").agg(F.max("keeper").alias("stay"), F.count("*").alias("times"))
    joined, new = join_rows(docs, broadcast_if_small(gone.filter("not stay or times > 1")), id_col, text_col, "left")
    stay = F.col(new["stay"])
    again = joined.filter(stay).dropDuplicates([id_col, text_col])
    return joined.filter(stay.isNull()).unionByName(again).select(*quoted(docs.columns))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT rid, list_aggregate(list_slice(ws, p, p + 4), 'string_agg', ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS p FROM d WHERE len(ws) > 0)
), n AS MATERIALIZED (SELECT rid, count(*) AS n FROM s GROUP BY rid
), link AS MATERIALIZED (
  SELECT a.rid AS u, b.rid AS v FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid
  JOIN n x ON x.rid = a.rid JOIN n y ON y.rid = b.rid
  GROUP BY a.rid, b.rid, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
  SELECT rid AS u, rid AS v FROM d
  UNION
  SELECT reach.u, link.v FROM reach JOIN link ON link.u = reach.v
)
SELECT a.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(b.doc_id) AS component_id
FROM reach JOIN d a ON a.rid = reach.u JOIN d b ON b.rid = reach.v LEFT JOIN n ON n.rid = a.rid
GROUP BY a.rid, a.doc_id, n.n
"""
