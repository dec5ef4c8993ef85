"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for URLs without a rule.

Rules are a table (host, path, verdict). The distinct hosts' suffixes, as deep as the deepest rule, are joined with
it, which gives each host its rules, longest first; a URL takes the first whose path starts its own. The host table is
broadcast only if it is measured to be small.

Model: every URL has numeric features of its characters alone (length, depth of host and path, digit ratio, entropy,
hyphens, parameter count, longest token) and suffix statistics: the smoothed share of blocked URLs among the labelled
ones whose host ends in the same one, and the same two, labels. For a labelled URL its own label is left out of
these shares, so that the model can't read its answer there. Features are cut into bins by quantiles; each round
fits a tree of limited depth to the gradient of the log loss (histograms of gradient and hessian per bin) and adds a
small step of it. Training takes at most ``max_rows`` labelled URLs, the smallest hashes; the trees go out with the
tasks and URLs are scored in Arrow batches, feature by feature.

Edge cases: a null URL, or one without ``://``, has empty host and path and is scored like an empty text; an empty
path starts with no rule's ``/``; of two rules of one length the one with the longer host wins, then block; labels
other than 0 (allow) and 1 (block) and null URLs aren't learned from; labels of one class give its smoothed share as every
score; equal rows get equal verdicts; only the two given columns of pages are read, so further columns, whatever their
names, don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.session import broadcast_if_small

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MAX_ROWS = 20_000
THRESHOLD = 0.5
BINS = 24
DEPTH = 3
ROUNDS = 60
RATE = 0.2
LEAST_HESSIAN = 1.0
SMOOTHING = 4.0

# A small labelled table: invented URLs as a reviewer would file them. Blocked: link farms, pill and casino shops, phishing, parked
# and generated hosts, session and tracking links. Allowed: articles, documentation, shops, forums, public bodies.
BLOCKED = """
http://cheap-watches-online.com/buy/?id=1 http://best-casino-bonus.net/win http://www.free-ringtones-download.org/x
http://get-rich-quick.biz/start http://online-loans-fast.info/apply?aff=77&sub=3 https://win-free-prizes.example.org/en/12
http://spam-links-farm.com/en/44 http://www.replica-bags-outlet.com/fr/8?page=3&ref=a http://diet-pills-now.net/de/91
http://adult-cams-live.tv/room/4 http://discount-meds-shop.com/en/301.html http://www.link-farm-directory.org/en/77/
http://buy-followers-cheap.com/ http://poker-chips-bonus.example.com/en/5 http://payday-cash-now.info/a?x=1&y=2&z=3
http://xn--80ak6aa92e.com/login http://192.0.2.17/secure/login.php?acc=8812 http://198.51.100.4/~tmp/update.exe
http://203.0.113.99/a/b/c/d/e.html http://account-verify-update.com/signin?session=9f8e7d6c5b4a http://secure-login-bank.info/id/00112233
http://paypa1-security-check.com/webscr?cmd=login http://app1e-id-locked.net/unlock?u=77 http://micros0ft-support-desk.com/call
http://a8f3k2j9x7q1.com/ http://q7w8e9r0t1y2u3.net/p http://zx81kd02mf93.info/index.php?q=a&w=b&e=c&r=d
http://f3d9a1c7e5b2.top/1 http://77881234-shop.com/i/99 http://m4k2-b7q9-x1z5.org/en/3
http://track.clk-srv77.com/r?u=1&s=2&c=3&p=4&z=5 http://ads.pop-under-net.com/click?zone=18&cid=4477&aff=901&sid=77e8
http://go.redirect-hub.net/?url=aHR0cDovL2V4YW1wbGU&k=12&t=99 http://l.short-urls-4u.com/x7Gh2 http://cdn.banner-xchange.org/b?w=468&h=60&z=3&r=991
http://shop-24-7-deals.biz/p/77120981?sid=99817263&ref=8812&aff=3 http://hot-singles-nearby.com/?loc=1 http://mega-bonus-slots.net/spin/7
http://warez-cracks-keygen.org/dl/8812 http://torrent-movies-hd.info/dl?id=99812 http://essay-writers-cheap.com/order?p=5
http://seo-backlinks-4-sale.com/1 http://domain-parking-page.net/ http://expired-names-auction.org/lot/7
http://bit-coin-doubler.biz/x2 http://forex-signals-vip.com/join?ref=12&src=mail http://crypto-airdrop-claim.net/wallet?k=77
http://www.cheap-flights-4-you.info/?a=1&b=2 http://vi4gr4-0nline.com/en/7 http://c1al1s-sh0p.net/en/1
http://casino-x-777.com/fr/2 http://777-lucky-spin.org/es/4 http://lotto-winner-2020.info/claim?ticket=00918273645
http://free-gift-cards-now.com/en/450?page=2&ref=x http://your-pc-is-infected.com/scan?v=8 http://update-flash-player.net/get.exe
http://download-free-codecs.org/c.exe http://mp3-search-engine.info/s?q=a&p=1&n=50&o=2 http://toolbar-install-now.com/tb?aff=4411
http://weight-loss-secret.net/en/13/ http://work-at-home-jobs.biz/de/5 http://penny-stock-tips.org/en/853/
http://cheap-hosting-farm.example.net/en/2 http://fake-news-generator.example.org/fr/8 http://auto-blog-farm.example.com/de/3?utm_source=feed
http://content-spinner-pro.com/en/6 http://keyword-stuffed-page.net/en/9#top http://doorway-page-maker.org/es/7
""".split()
ALLOWED = """
https://www.riverdaleherald.com/news/2019/05/council-votes-on-library https://blog.maplestreet.org/en/2020/garden-notes
https://en.wikimirror.org/wiki/Photosynthesis https://docs.pythonhelp.org/3/library/itertools.html https://www.statelibrary.gov/collections/maps
https://news.harborpost.com/en/853/ https://www.cityofelm.gov/services/parking https://forum.woodworkers.net/t/dovetail-joints
https://museum.northfield.edu/exhibits/ https://blog.thompson.com/en/671 https://www.kitchenstories.com/en/88.html
https://m.dailyledger.net/es/384 https://recipes.grandmother.org/fr/414 https://www.sailingclub.org/en/471
https://physics.lakeside.edu/papers/optics.html https://support.lampworks.com/kb/article/resetting https://www.birdwatch.org/de/612
https://journal.medreview.org/vol12/issue3/abstract https://shop.teahouse.com/en/oolong https://www.orchestra.org/season/concerts
http://blog.henderson.net/en/960 http://therapynotes.com/en/825?page=2 https://gardening.example.com/en/148.html
http://www.mountaineers.org/en/328/ https://weather.coastal.gov/forecast https://www.bookreview.com/fr/65.html
https://history.village.org/en/334/ https://m.theatre.com/en/25#top https://code.opencompiler.org/manual/syntax
https://www.newtonschool.edu/parents/calendar https://travel.wanderer.com/es/797#top https://www.astronomy.org/de/632
https://blog.example.net/en/533/ https://stories.example.org/fr/685 https://www.chessclub.example.com/en/676
http://www.localpaper.example.net/en/455?utm_source=feed http://poets.example.org/en/728 https://wiki.example.com/de/474.html
https://cooking.example.net/fr/762 https://health.example.org/es/978?page=2&ref=x https://sports.example.com/en/625.html
https://www.railwaymuseum.co.uk/visit https://parliament.gov.uk/bills/2021/17 https://universitaet.de/forschung/projekte
https://lemonde-regional.fr/culture/article.html https://elpais-local.es/ciencia https://openaccess.org/journals/biology
https://blog.stringtheory.org/en/412 https://www.quiltmakers.com/patterns/star https://m.harvest.org/en/25
https://www.lighthouse.net/en/171 http://pottery.net/en/369#top http://www.threads.com/fr/93?page=2&ref=x
https://northernlights.org/en/501?utm_source=feed https://www.translators.net/de/250/ http://ornithology.com/es/77/
https://letters.example.com/en/33/ http://www.gazette.example.org/de/118.html https://m.radio.example.net/fr/902?page=2&ref=x
""".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``url, label`` (1: block) of the module's small table."""
    return spark.createDataFrame([(u, 1) for u in BLOCKED] + [(u, 0) for u in ALLOWED], "url string, label int")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` (null: none fits) to rows with ``host`` and ``path``; ``rules``: host, path, verdict."""
    depth = rules.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 1
    labels = F.split("host", r"\.", -1)
    hosts = urls.select("host").distinct().withColumn("_n", F.size(labels))
    deep = F.sequence(F.greatest(F.col("_n") - depth, F.lit(0)), F.col("_n") - 1)  # of a host, no more suffixes than rules are deep
    suffix = F.transform(deep, lambda i: F.array_join(F.slice(labels, i + 1, F.col("_n")), "."))
    own = rules.select(F.col("host").alias("_suffix"), F.struct((-F.length("host") - F.length("path")).alias("a"), (-F.length("host")).alias("b"), F.col("verdict") != "block", F.col("path").alias("path"), F.concat("host", "path").alias("rule"), F.col("verdict").alias("verdict")).alias("r"))
    fits = hosts.select("host", F.explode(suffix).alias("_suffix")).join(broadcast_if_small(own), "_suffix")
    listed = fits.groupBy(F.col("host").alias("_host")).agg(F.sort_array(F.collect_list("r")).alias("_rules"))
    joined = urls.join(broadcast_if_small(listed), F.col("host") == F.col("_host"), "left")
    first = F.get(F.filter("_rules", lambda r: F.col("path").startswith(r["path"])), F.lit(0))
    return joined.withColumn("_r", first).withColumns({"rule": F.col("_r.rule"), "rule_verdict": F.col("_r.verdict")}).drop("_r", "_rules", "_host")


# ---------------------------------------------------------------- features
FEATURES = ("length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio", "entropy", "host_hyphens",
            "parameters", "query_length", "longest_token", "vowel_ratio", "suffix_1_share", "suffix_2_share", "suffix_2_known")
_VOWELS = b"aeiou"


def _entropy(text: bytes) -> float:
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=1)
    share = counts[counts > 0] / max(1, len(text))
    return float(-(share * np.log2(share)).sum())


def split_url(url: str | None) -> tuple[bytes, bytes, bytes]:
    """Host (lower case), path and query of a URL, as bytes."""
    _, found, rest = (url or "").encode("utf-8", "replace").partition(b"://")
    if not found:
        return b"", b"", b""
    rest = rest.partition(b"#")[0]
    before, _, query = rest.partition(b"?")
    host, slash, path = before.partition(b"/")
    return host.lower(), slash + path, query


def _suffixes(host: bytes) -> tuple[bytes, bytes]:
    labels = host.split(b".")
    return labels[-1], b".".join(labels[-2:])


@dataclass
class SuffixStatistics:
    """Labelled URLs and blocked ones per host suffix of one and of two labels."""

    counts: dict[bytes, tuple[int, int]] = field(default_factory=dict)
    share: float = 0.5

    def learn(self, urls: list[str], labels: list[int]) -> SuffixStatistics:
        self.share = (sum(labels) + 1) / (len(labels) + 2)
        for url, y in zip(urls, labels, strict=True):
            for place, s in enumerate(_suffixes(split_url(url)[0])):
                n, k = self.counts.get(b"%d" % place + s, (0, 0))
                self.counts[b"%d" % place + s] = (n + 1, k + y)
        return self

    def shares(self, host: bytes, own: int | None = None) -> list[float]:
        """Smoothed shares of the two suffixes and the log of the second's count; ``own``: this URL's label, left out."""
        out = []
        for place, s in enumerate(_suffixes(host)):
            n, k = self.counts.get(b"%d" % place + s, (0, 0))
            if own is not None and n:
                n, k = n - 1, k - own
            out.append((k + SMOOTHING * self.share) / (n + SMOOTHING))
        return [*out, float(np.log1p(n))]


def features(urls: list[str | None], statistics: SuffixStatistics, labels: list[int] | None = None) -> np.ndarray:
    """One row of :data:`FEATURES` per URL."""
    out = np.zeros((len(urls), len(FEATURES)))
    for row, url in enumerate(urls):
        host, path, query = split_url(url)
        body = host + path + query
        digits = sum(map(body.count, b"0123456789")) if body else 0
        host_digits = sum(map(host.count, b"0123456789")) if host else 0
        letters = sum(c in b"abcdefghijklmnopqrstuvwxyz" for c in host)
        tokens = body.replace(b"/", b" ").replace(b".", b" ").replace(b"-", b" ").replace(b"=", b" ").replace(b"&", b" ").split()
        out[row] = (
            len(body), len(host), len(path), host.count(b".") + bool(host), sum(map(bool, path.split(b"/"))), digits / max(1, len(body)), host_digits / max(1, len(host)),
            _entropy(host), host.count(b"-"), sum(map(bool, query.split(b"&"))), len(query), max(map(len, tokens), default=0),
            sum(c in _VOWELS for c in host) / max(1, letters), *statistics.shares(host, labels[row] if labels else None),
        )
    return out


# ---------------------------------------------------------------- boosted trees
@dataclass
class Tree:
    """Nodes in breadth-first order; a leaf has feature -1. Children of node k are 2k+1 and 2k+2."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        for _ in range(DEPTH):
            f = self.feature[at]
            inner = f >= 0
            right = bins[np.arange(len(bins)), np.maximum(f, 0)] > self.cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return self.value[at]


def _grow(bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> Tree:
    size = 2 ** (DEPTH + 1) - 1
    tree = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size))
    rows_of = {0: np.arange(len(bins))}
    for node in range(size):
        rows = rows_of.pop(node, None)
        if rows is None:
            continue
        total_g, total_h = g[rows].sum(), h[rows].sum()
        tree.value[node] = total_g / (total_h + 1)
        best = (1e-6, -1, 0)
        for f in range(bins.shape[1] if node < size // 2 else 0):
            left_g = np.cumsum(np.bincount(bins[rows, f], g[rows], BINS))[:-1]
            left_h = np.cumsum(np.bincount(bins[rows, f], h[rows], BINS))[:-1]
            fine = (left_h >= LEAST_HESSIAN) & (total_h - left_h >= LEAST_HESSIAN)
            gain = np.where(fine, left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1), 0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
        if best[1] >= 0:
            tree.feature[node], tree.cut[node] = best[1], best[2]
            right = bins[rows, best[1]] > best[2]
            rows_of[2 * node + 1], rows_of[2 * node + 2] = rows[~right], rows[right]
    return tree


@dataclass
class Model:
    statistics: SuffixStatistics
    start: float
    edges: list[np.ndarray]
    trees: list[Tree]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def score(self, urls: list[str | None]) -> np.ndarray:
        """Probability that a URL is to be blocked."""
        total = np.full(len(urls), self.start)
        if self.trees and urls:
            b = self.bins(features(urls, self.statistics))
            for tree in self.trees:
                total += RATE * tree.score(b)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit(urls: list[str], labels: list[int], rounds: int = ROUNDS) -> Model:
    statistics = SuffixStatistics().learn(urls, labels)
    model = Model(statistics, float(np.log(statistics.share / (1 - statistics.share))), [], [])
    if not 0 < sum(labels) < len(labels):
        return model
    x, y = features(urls, statistics, labels), np.array(labels, float)
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    b = model.bins(x)
    total = np.full(len(y), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        tree = _grow(b, y - p, p * (1 - p))
        model.trees.append(tree)
        total += RATE * tree.score(b)
    return model


def train(labelled: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled URLs (``url, label``); of several labels of one URL the largest counts."""
    known = labelled.where(F.col("url").isNotNull() & F.col("label").isin(0, 1)).groupBy("url").agg(F.max("label").alias("label"))
    rows = known.orderBy(F.xxhash64("url"), "url").limit(max_rows).collect()  # bounded: max_rows
    return fit([r["url"] for r in rows], [int(r["label"]) for r in rows])


def judge(pages: DataFrame, rules: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``: the rule's verdict, else the model's."""

    @F.pandas_udf("double")
    def scored(urls: pd.Series) -> pd.Series:
        return pd.Series(model.score(urls.tolist()))

    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), scored(url).alias("score"))
    found = match_rules(rows, rules)
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")


def filter_urls(pages: DataFrame, rules: DataFrame | None = None, labelled: DataFrame | None = None, **options) -> DataFrame:
    """:func:`judge` with the given rules and labels, or the module's."""
    spark = pages.sparkSession
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string") if rules is None else rules
    return judge(pages, rules, train(labelled_urls(spark) if labelled is None else labelled), **options)
