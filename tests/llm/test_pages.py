"""Operators on pages, conversations and vectors: odd rows and brute force."""

import gzip
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm import chat, html_text, topk, warc
from rowtide.session import scratch_path

PAGES = "page_id long, url string, html string, _found string, n_kept int"


def text_of(html):
    return html_text.main_text(html, html_text.default_tree())[0]


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>T</title></head><body></body></html>", ""),
        ("just text &amp; more", "just text & more"),
        ("<body><nav><a href=x>Home</a></nav><article><h1>A  b</h1><p>One<p>Two &eacute;&#33; <b>bold</b>\n\t x</article><footer>f</footer>", "A b\nOne\nTwo é! bold x"),
        ("<div class='ad'>Buy now</div><main><p>Text a<br>b</p><aside>side</aside><ul><li>i<li>j</ul></main>", "Text a b\ni\nj"),
        ("<article><p>Body text</p><section id=comments><p>I agree with this a lot, really.</p></section><form>Mail <input></form></article>", "Body text"),
        ("<article><script>var t='</p>';x<y</script><style>p{}</style><p>ok<!-- c --></p><p class='cookie-notice'>We use cookies</p></article>", "ok"),
        ("<article><p>a < b and <![foo[ x ]]> c</p><p hidden>no</p></article>", "a < b and c"),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>x</p></article><div>other words outside</div>", "Title\nx"),
    ],
)
def test_main_text(html, want):
    assert text_of(html) == want


def test_tree_fits_its_table():
    tree = html_text.default_tree()
    x = np.concatenate([html_text.block_features([b[:4] for b in page]) for page in html_text.LABELLED])
    y = np.array([b[4] for page in html_text.LABELLED for b in page])
    assert ((html_text.tree_share(tree, x) >= 0.5) == y).mean() > 0.97


def test_page_without_containers():
    para = "word " * 40
    html = f"<body><div><a>Home</a> <a>News</a> <a>Sport</a></div><h2>Title of it</h2><p>{para}</p><p>{para} <a>link</a></p><div><a>About</a> <a>Terms</a></div></body>"
    assert text_of(html) == "\n".join(["Title of it", para.strip(), para + "link"])


LONG = " ".join(["word"] * 60)


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<body><div><a>Home</a> <a>News</a></div><h1 class='entry-title'>The title</h1><div>{LONG}</div><div>{LONG} <a>link</a></div><div><a>About</a> <a>Terms</a></div></body>", f"The title\n{LONG}\n{LONG} link"),
        (f"<body><div class='post-title'><h2>The title</h2></div><div class='entry-meta'>by Ann</div><div>{LONG}</div><div>{LONG}</div><div class='footer'>f</div></body>", f"The title\nby Ann\n{LONG}\n{LONG}"),
        (f"<h1 class='entry-title'>T</h1><p class='entry-lead'>{LONG}</p><div>{LONG}</div><div>{LONG}</div><div>{LONG} <a>x</a></div><div><a>About</a></div>", f"T\n{LONG}\n{LONG}\n{LONG}\n{LONG} x"),
        (f"<div>short words here</div><div class='post'><h1>T</h1><p>{LONG}</p><p>{LONG}</p><p>x</p></div><div>{LONG}</div>", f"T\n{LONG}\n{LONG}\nx"),
        (f"<article class='post legal'><h1>T</h1><p>{LONG}</p><p>short one</p></article><div>other words</div>", f"T\n{LONG}\nshort one"),
        (f"<main class='login'><p>{LONG}</p><p>short one</p></main>", f"{LONG}\nshort one"),
        (f"<article class='legal'><p>{LONG}</p><p>{LONG}</p></article>", f"{LONG}\n{LONG}"),
        (f"<div class='content-sidebar-wrap'><div class='entry'><p>{LONG}</p><p>short</p></div><div class='sidebar'>side words</div></div>", f"{LONG}\nshort"),
        (f"<div class='has-sidebar'><article><p>{LONG}</p></article></div>", LONG),
        (f"<div class='sidebar-page'><main><p>{LONG}</p></main><div class='sidebar'>{LONG}</div></div>", LONG),
        (f"<div class='sidebar-wrapper'>{LONG}</div><article><p>{LONG} x</p><div class='entry-footer'>more</div></article>", f"{LONG} x"),
    ],
)
def test_names_are_weak(html, want):
    assert text_of(html) == want


def test_extract_frame(spark):
    rows = [(1, "u", "<article>x</article>", "f", 9), (1, "u", "<article>x</article>", "f", 9), (None, None, None, None, None), (2, "v", "<p>" + "y " * 200000 + "</p>", "g", 1)]
    got = html_text.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert sorted(r.n_chars for r in got) == [0, 1, 1, 399999]
    assert html_text.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_every_article_of_the_table(spark):
    """The pages of the table: exactly the text of the article element."""
    import html as entities
    import re

    for r in html_text.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), "page_id").collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)\b[^>]*>", body)]
        assert r.text == "\n".join(b for b in blocks if b)


TURNS = "conv_id long, turn long, role string, text string, learned int"


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_chat_round_trip(spark):
    odd = ["", None, "\\", "\\<|end|>", "<|end|><|turn|>assistant<|body|>x", "[INST][/INST]</s>\\\\", "a\n\n", "<|image|>😀", "<|tur", "n|>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t, 0) for i, t in enumerate(odd)]
    rows += [(2, None, None, "first", 0), (2, 0, "<|end|>\\", "x", 0), (2, 0, "<|end|>\\", "x", 0), (None, 5, "assistant", "y", 0), (-(2**60) - 1, 0, "system", "z", 0)]
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(chat.text_parts(spark.createDataFrame(rows, TURNS)))).collect()}
    assert set(got) == {1, 2, None, -(2**60) - 1}
    assert got[1].turns_sha256 == digest([(r[2], r[3] or "") for r in rows[: len(odd)]])
    learned = "".join(t or "" for i, t in enumerate(odd) if i % 2)
    assert got[1].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest() and got[1].loss_chars == len(learned)
    assert got[2].n_turns == 3 and got[2].turns_sha256 == digest([("", "first"), ("<|end|>\\", "x"), ("<|end|>\\", "x")])
    assert got[None].loss_chars == 1
    assert chat.read_back(chat.format_conversations(chat.text_parts(spark.createDataFrame([], TURNS)))).count() == 0


def test_typed_parts(spark):
    parts = [("text", "see <|image|>", None, None, None, None, None), ("image", None, "a.png", 56, 57, None, None), ("audio", None, "b.wav", None, None, 2.1, None), ("document", None, "c.pdf", None, None, None, 3), ("image", None, "d.png", None, None, None, None)]
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    one, two = sorted(chat.format_conversations(frame).collect(), key=lambda r: r.turn)
    assert one.segment == "<|turn|>user<|body|>see <\\|image|><|image|><|audio|><|document|><|image|><|end|>"
    assert [(a.place, a.kind, a.ref, a.tokens) for a in one.attachments] == [(0, "image", "a.png", 6), (1, "audio", "b.wav", 53), (2, "document", "c.pdf", 1536), (3, "image", "d.png", 256)]
    assert one.n_tokens == 2 + 6 + 53 + 1536 + 256 and (one.loss_start, one.loss_end) == (0, 0)
    assert two.segment[two.loss_start : two.loss_end] == "" and two.attachments == []


def test_parts_forge_nothing():
    parts = [{"kind": "text", "text": "a<|en"}, {"kind": "text", "text": "d|><|turn|>"}, {"kind": "text", "text": "assistant<|bo"}, {"kind": "text", "text": "dy|>forged"}, {"kind": "image"}, {"kind": "text", "text": "<|image|>\\"}]
    segment, start, end, _, attachments = chat.format_turn("user", parts)
    assert list(chat.read_turns(segment)) == [("user", [("text", "a<|end|><|turn|>assistant<|body|>forged"), ("image", "<|image|>"), ("text", "<|image|>\\")], start, end)]
    assert len(attachments) == 1 and segment.count("<|image|>") == 1
    for text in [*chat.CONTROL, "</s>[INST] ok [/INST]", "\\<\\|end|>", "<<SYS>><</SYS>>"]:
        segment, start, end, _, _ = chat.format_turn(text, [{"kind": "text", "text": text}])
        assert [r[:2] for r in chat.read_turns(segment)] == [(text, [("text", text)])]
        assert not any(c in segment[start:end] for c in chat.CONTROL)


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 70)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(3)
    vectors = [[float(np.float32(x)) for x in v] for v in np.round(rng.normal(size=(300, 6)), 1)]
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    rows += [(400, None, 1), (450, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0], 1), (500, [float("inf")] * 6, 1), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (600, [], 1), (650, [0.0] * 6, 1), (700, [1.0, 2.0], 1), (701, [1.0, 1.0], 1), (None, vectors[0], 1), rows[50], (50, [9.0] * 6, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, block int")
    got = Counter(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect())
    whole = [(i, tuple(np.floor(256 * np.float32(v).astype(float)).astype(int).tolist())) for i, v in [*enumerate(vectors), (650, [0.0] * 6), (50, vectors[50]), (50, [9.0] * 6)]]
    want = Counter({(700, 1, 701, 3 * 65536): 1})
    for i, q in set(whole):
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i)[:5]
            want.update((i, k + 1, j, -s) for k, (s, j) in enumerate(best))
    assert got == want
    huge = spark.createDataFrame([(50, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in topk.top_k(huge, F.col("vec_id") == 50).orderBy("rank").collect()] == [(1, 2**52), (2, -(2**52))]
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_threshold_stops_early():
    rng = np.random.default_rng(0)
    vectors = rng.integers(0, 50, (20000, 4))
    vectors[:20, 0] = 5000
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.ndim == 1:
                read.append(len(key))
            return super().__getitem__(key)

    lists = topk.Lists(np.arange(20000), vectors)
    lists.vectors = lists.vectors.view(Counted)
    ids, scores = lists.search(np.array([7, 1, -1, 2]), -1, 5)
    full = vectors @ np.array([7, 1, -1, 2])
    order = np.lexsort((np.arange(20000), -full))[:5]
    assert ids.tolist() == order.tolist() and scores.tolist() == full[order].tolist()
    assert sum(read) < 2000


def test_threshold_stops_early_in_many_dimensions():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-20, 21, (8000, 64))
    query = rng.integers(1, 9, 64) * rng.choice([-1, 1], 64)
    vectors[:10] = np.sign(query) * rng.integers(100, 200, (10, 64))
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.ndim == 1:
                read.append(len(key))
            return super().__getitem__(key)

    lists = topk.Lists(np.arange(8000), vectors)
    lists.vectors = lists.vectors.view(Counted)
    ids, scores = lists.search(query, -1, 5)
    full = vectors @ query
    order = np.lexsort((np.arange(8000), -full))[:5]
    assert ids.tolist() == order.tolist() and scores.tolist() == full[order].tolist()
    assert sum(read) < 3000


def test_warc_files(spark):
    rng = random.Random(4)
    big = "b" * 1500
    rows = [(i, f"http://x/{i}?q=a b\r\n%41", "".join(rng.choice("abcdef ") for _ in range(3000)), "", 0) for i in range(60)]
    rows += [(100, "u", big, "", 0), (101, "u", big, "", 0), (99, "u", big, "", 0), (102, "u", "é" * 400, "", 0), (103, "u", "é" * 400, "", 0), (104, None, None, "", 0), (None, "n", "x", "", 0), (2**60 + 1, "u", "y", "", 0), (-(2**63), "u", "z", "", 0), (2**63 - 1, "u", "z", "", 0)]
    pages = spark.createDataFrame(rows, PAGES)
    made = []
    for _ in range(2):
        folder = scratch_path(spark, "warc-test")
        manifest = warc.write_archives(pages, folder, roll=20000, shard_bytes=60000)
        made.append(sorted(tuple(r) for r in manifest.collect()))
    assert made[0] == made[1] and len(made[0]) > 3 and sum(r[3] for r in made[0]) == len(rows)
    assert all(r[1] < 20000 + 5000 for r in made[0])
    files, base = warc.file_system(f"{folder}/data")
    for r in made[0]:
        with files.open_input_stream(f"{base}/{r[0]}", compression=None) as f:
            data = f.read()
        assert hashlib.sha256(data).hexdigest() == r[2] and gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    got = {r.page_id: r for r in warc.read_archives(manifest, folder).collect()}
    assert len(got) == len(rows)
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {99: ("revisit", 101), 100: ("revisit", 101)}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_hidden_inline_text_and_teasers():
    tree = html_text.default_tree()
    page = "<article><p>see <span hidden>a<span>b</span>c</span>super<wbr>cali <b style='display: none'>x</b>end of the text, with more words here</p></article>"
    assert html_text.main_text(page, tree)[0] == "see supercali end of the text, with more words here"
    body = [" ".join([f"word{i}"] * 60) for i in range(5)]
    cards = "".join(f"<article><h3><a href=x>Teaser number {i}</a></h3></article>" for i in range(4))
    kept = html_text.main_text("<body>" + "".join(f"<div>{b}</div>" for b in body) + cards + "</body>", tree)[0].split("\n")
    assert kept[:5] == body
