"""Operators on documents: odd rows, brute force, copies."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowtide.llm import jaccard_join, packing, quality_model, quality_rules, secret_scan
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, _found_doc_id int, kept int"
PATH = public_tokenizers.path("word_bpe_49k.json")
HEX = "0123456789abcdef0123456789abcdef"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(5)
    good = [prose(rng, 60) for _ in range(12)]
    texts = [None, "", " \n\t", "one", "one two three four", "one two three four", f'password="{HEX}" and AKIA{"Q" * 16} x', prose(rng, 30000), *good, good[0], good[0] + " more"]
    texts += [f"{g}\nAll rights reserved by the site.\n" for g in (prose(rng, 40) for _ in range(14))]
    texts += ["All rights reserved by the site.\n" + "\n".join(["All rights reserved by the site."] * 3)]
    rows = [(i, t, "en", "a" if i % 2 else None, None, "x", 1, 0) for i, t in enumerate(texts)]
    return [*rows, rows[8], (None, None, None, None, None, None, None, None), (None, good[1], None, None, 3, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.quality_rules(none).count() == 0
    assert quality_model.classify(none, labels).count() == 0
    assert jaccard_join.near_duplicates(none).count() == 0
    assert secret_scan.report(secret_scan.scan_secrets(none)).count() == 0
    assert packing.pack_documents(none, PATH).count() == 0
    for stage in (quality_rules.keep_good, secret_scan.redact, jaccard_join.keep_one):
        assert stage(none).columns == odd.columns


def test_rules(odd, odd_rows):
    got = quality_rules.quality_rules(odd, max_docs=5).collect()
    assert len(got) == len(odd_rows)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for d, t, *_ in odd_rows:
        assert any(r.n_words == len(brute.words(t)) and r.base_failed == (len(brute.words(t)) < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in by[d])
    assert by[8][0] == by[8][1]
    marked = [r for r in got if r.doc_id is not None and 22 <= r.doc_id < 36]
    assert all(r.kept and r.n_removed_words == 6 for r in marked)
    kept = quality_rules.keep_good(odd, max_docs=5)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in got)


def test_rules_reject_depleted_and_keep_copies(spark):
    rng = random.Random(2)
    lines = [prose(rng, 12) for _ in range(3)]
    base = [prose(rng, 10) for _ in range(8)]
    rows = [(i, "\n".join([*lines, prose(rng, 8)]), "h") for i in range(20)]
    rows += [(300 + i, "\n".join([lines[i % 3], prose(rng, 70)]), "h") for i in range(90)]
    rows += [(100 + i, "\n".join(base), "h") for i in range(30)]
    rows += [(200 + i, "\n".join([*base[:i % 8], prose(rng, 10), *base[i % 8 + 1 :]]), "h") for i in range(30)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[i].kept for i in range(20)) and not any(got[i].base_failed for i in range(20))
    assert all(got[i].kept for i in got if i >= 100)


def test_rules_reject_template_pages(spark):
    rng = random.Random(6)
    template = [prose(rng, 15) for _ in range(6)]
    rows = [(i, "\n".join([*template[:3], prose(rng, 5), *template[3:], prose(rng, 5)]), "h") for i in range(1000)]
    base = [prose(rng, 10) for _ in range(12)]
    rows += [(2000 + i, "\n".join([*base[: i % 12], prose(rng, 10), *base[i % 12 + 1 :]]), "h") for i in range(240)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[i].kept or got[i].base_failed for i in range(1000))
    assert all(got[i].n_removed_words == 90 for i in range(1000))
    assert all(r.kept and r.n_removed_words == 0 for i, r in got.items() if i >= 2000)


def test_lines_are_known_by_64_bits(spark):
    docs = spark.createDataFrame([(0, "\n".join(f"line {chr(97 + i)}" for i in range(26)), "h")], "doc_id long, text string, source string")
    lines = [x["l"] for x in quality_rules.measure(docs).first()["_hashed"]]
    assert len(set(lines)) == 26 and max(abs(x) for x in lines) >= 2**60


def test_secrets(odd, odd_rows):
    got = secret_scan.report(secret_scan.scan_secrets(odd)).collect()
    assert Counter((r.doc_id, r.base_sha256) for r in got) == Counter((d, brute.base_digest(t or "")) for d, t, *_ in odd_rows)
    masked = {r.doc_id: r for r in secret_scan.redact(odd).collect()}
    assert masked[6].text == '[secret:assign]" and [secret:access] x' and masked[6].n_chars == len(masked[6].text)
    assert secret_scan.redact(odd).columns == odd.columns
    assert masked[9].text == odd_rows[9][1] and masked[9].n_chars is None


def test_redaction_against_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r.doc_id: r.found for r in secret_scan.scan_secrets(docs).collect()}
    kinds = list(secret_scan.KINDS)
    for r in secret_scan.redact(docs).join(docs.select("doc_id", F.col("text").alias("old")), "doc_id").collect():
        out, at = [], 0
        for x in found[r.doc_id]:
            if x.s >= at:
                out += [r.old[at : x.s], f"[{'example' if x.example else 'secret'}:{kinds[x.k]}]"]
            at = max(at, x.e)
        want = "".join(out) + r.old[at:]
        assert r.text == want and r.n_chars == len(want)


def test_generic_tokens_with_a_late_digit(spark):
    tokens = ["aB" * 60 + "7", "z7" * 60 + "B", "B7" * 60 + "a", "x" * 100000 + "B7", "aB" * 60, "-" * 90 + "aB7"]
    docs = spark.createDataFrame([(i, f"see {t} here", "h") for i, t in enumerate(tokens)], "doc_id long, text string, source string")
    got = {r.doc_id: [(x.s, x.e) for x in r["_maybe"]] for r in secret_scan.candidates(docs).collect()}
    assert got == {i: [] if i == 4 else [(4, 4 + len(t))] for i, t in enumerate(tokens)}


def test_secret_positions_and_owners(spark):
    shared, own, token = "a1" * 16, "b2" * 16, "Ab3" * 9
    texts = [f"😀 x{i} token = '{shared}'. {'y' * i}" for i in range(6)] + [f"key {own} secret=abc token=abc12{'' if i else ' '}" for i in range(2)]
    texts += [f"see {token} {i}" for i in range(6)] + [f"only {'Zq7' * 10}", "api_key:secret=token", "AKIA" * 9, "ſecret=abcdef12"]
    docs = spark.createDataFrame([(i, t, f"s{i % 4}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secret_scan.report(secret_scan.scan_secrets(docs)).collect()}
    for i, t in enumerate(texts):
        assert got[i].base_sha256 == brute.base_digest(t)
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == x for _, k, _ in brute.base_spans(t)) for x in range(3)]
    assert got[0].n_example == 2 and got[0].n_live == 0
    assert got[6].n_live == 1 and got[6].n_example == 0
    assert "generic" not in got[8].spans and got[14].spans == "generic:5:35"


def test_join_against_brute_force(odd, odd_rows):
    rows = [(i, t) for i, (_, t, *_) in enumerate(odd_rows)]
    sets = {i: len(brute.shingles(t)) for i, t in rows}
    got = jaccard_join.near_duplicates(odd).collect()
    assert Counter(r.n_shingles for r in got) == Counter(sets.values())
    part = defaultdict(list)
    for i, c in brute.components(rows).items():
        part[c].append(odd_rows[i][0])
    want = Counter((d, min((x for x in ds if x is not None), default=None)) for ds in part.values() for d in ds)
    assert Counter((r.doc_id, r.component_id) for r in got) == want
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(1 if sets[c] else len(part[c]) for c in part)


@pytest.mark.parametrize("chunk", [16, 4096])
def test_join_on_large_groups(spark, monkeypatch, chunk):
    """Groups longer than a list, a passage that all documents share, and lists split into chunks."""
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "SHORT", 4)
    rng = random.Random(7)
    passage = prose(rng, 55).split()
    rows = []
    for base in (prose(rng, 60).split(), prose(rng, 25).split(), []):
        for _ in range(60):
            words = [*base, *passage]
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = prose(rng, 1)
            rows.append((len(rows), " ".join(words)))
    for _ in range(40):
        rows.append((len(rows), " ".join([*prose(rng, rng.randint(4, 40)).split(), *passage])))
    want = brute.components(rows)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_ngrams_by_blocks(monkeypatch):
    text = prose(random.Random(3), 4000)
    whole = jaccard_join.ngrams(text)
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    assert (jaccard_join.ngrams(text) == whole).all() and len(whole) == len(brute.shingles(text))


def test_packing(odd, odd_rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    got = packing.pack_documents(odd, PATH).collect()
    want = Counter()
    for d, t, *_ in odd_rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
        want.update((d, k, s, min(2048, n - s)) for k, s in enumerate(range(0, n, 2048)))
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == want
    check_sequences(got)


def check_sequences(rows):
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(used)


def test_packing_is_best_fit_decreasing(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    rng = random.Random(1)
    sizes = [rng.choice([1, 3, 700, 1024, 1025, 2047, 2048, rng.randint(1, 2048)]) for _ in range(900)]
    rows = [(i, 0, 0, s, 7) for i, s in enumerate(sizes)]
    got = packing.pack(spark.createDataFrame([*rows, rows[0], rows[0]], "doc_id long, piece int, start long, length long, ids_crc32 long")).collect()
    assert len(got) == 902
    gaps = []
    for s in sorted([*sizes, sizes[0], sizes[0]], reverse=True):
        fit = min((g for g in gaps if g >= s), default=None)
        if fit is None:
            gaps.append(2048 - s)
        else:
            gaps.remove(fit)
            gaps.append(fit - s)
    assert check_sequences(got) == len(gaps)


def test_words_are_tokenised_as_in_the_text():
    from tokenizers import Tokenizer

    own, tokenizer = packing.WordEncoder(PATH), Tokenizer.from_file(PATH)
    texts = ["It's  UPPER\tand\nlower.", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|> A<|endoftext|>B", "x²½µ × ÷ ª ſ K İ", "é é ΑΣ ß 日本 😀 x\x0by z\x1cq", "", None, "don't 12,345 ###!!", "́ alone"]
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_model.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.predicted == got.quality)[got.held_out].mean() > 0.97
    again = quality_model.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert np.allclose(got.sort_values("doc_id").score, again.sort_values("doc_id").score)


def test_classifier_odd(spark, odd, odd_rows):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(None, 1, 0), (3, None, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality_model.classify(odd, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    one = quality_model.classify(odd, labels.filter("quality = 1")).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.7
    assert quality_model.keep_good(odd, labels).columns == odd.columns


def test_pair_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.fit(x, y, rounds=10)
    assert (0, 1) in {tuple(sorted(p)) for p in model.pairs}
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def test_pipeline_against_its_parts(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality_model.classify(docs, labels).collect() if r.predicted}
    left = docs.filter(F.col("doc_id").isin(*good))
    ruled = {r.doc_id for r in quality_rules.quality_rules(left).collect() if r.kept}
    comps = brute.components([(d, texts[d]) for d in ruled])
    stay = {d for d in ruled if comps[d] == d}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == stay
    check_sequences(got)
    clean = [d for d in stay if not brute.base_spans(texts[d])]
    assert clean
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5


def test_thue_morse_words_are_no_copies(spark):
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, f"{word} c d e f"), (2, f"{other} c d e f")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs).collect()} == {1: 1, 2: 2}


def test_other_tokenizer_files_are_used_whole():
    import pyarrow as pa
    from tokenizers import Tokenizer

    texts = ["It's a test, isn't it?", "Don\u2019t  stop\tnow\n", "\u00c4\u00e9 <|endoftext|> x", None, ""]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        plain = Tokenizer.from_file(path)
        got = packing.encoder(path).encode(pa.array(texts))
        assert got == [packing.pack_ids(plain.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_pieces_by_the_tokenizer(spark):
    import zlib

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(tuple(r) for r in packing.pack_documents(docs, PATH).select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    want = []
    for d in docs.collect():
        ids = [*plain.encode(d.text or "", add_special_tokens=False).ids, 0]
        want += [(d.doc_id, k, s, len(ids[s : s + 2048]), zlib.crc32(packing.pack_ids(ids[s : s + 2048]))) for k, s in enumerate(range(0, len(ids), 2048))]
    assert got == sorted(want)
