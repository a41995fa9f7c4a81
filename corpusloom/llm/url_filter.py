"""URL verdicts: rules by host and path, and a logistic regression for what no rule fits.

The regression sees hashed character n-grams of host and path. It is trained in numpy on a
small table of labelled urls, by default ``LABELLED_URLS``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, drop_clashing

by_value(__name__)

BUCKETS = 1 << 15
NGRAMS = (3, 4, 5)
#: Labelled urls that are fitted on, at most.
SAMPLE = 20_000
EPOCHS = 300
RATE = 0.1
DECAY = 1e-5
THRESHOLD = 0.5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OUTPUT = ("host", "path", "rule", "score", "verdict")

#: Words of hosts that are labelled as blocked, and of hosts that are labelled as allowed: common nouns, in alphabetical order.
BLOCKED_WORDS = (
    "adult", "porn", "xxx", "sex", "nude", "escort", "hentai", "casino", "poker", "slots", "bets", "betting",
    "gambling", "jackpot", "lottery", "pills", "viagra", "cialis", "pharma-cheap", "cheap-meds", "spam", "spam-link",
    "link-farm", "ads", "ads-server", "adtrack", "track", "tracker", "click-track", "popup", "malware", "phishing",
    "warez", "crack-keys", "torrent-free", "free-money", "free-win", "win-big", "payday", "loans-fast", "replica-watch",
)
ALLOWED_WORDS = tuple(
    """
    academy account agency airport album animal archive art article atlas auction author autumn award bakery bank beach bicycle
    bird blog board boat book border bridge budget building business camera campus canal career castle catalogue center chapter
    charity chemistry choir church cinema citizen city clinic clothing coach coast coffee college comedy community company concert
    congress cooking council country courses court craft culture cycling dance database dentist design desk dictionary digital
    dinner diploma doctor document drama driving economy editor education electric employer energy engine english estate
    evening event example exhibition expert factory family farm festival fiction film finance fishing flight flower football forest
    forum foundation furniture gallery garden geography geology glass government grammar guide guitar harbour health heritage
    hiking history holiday home horse hospital hotel house industry institute insurance island journal justice kitchen
    language law leader learning lecture legal letter library literature local magazine manual map market mathematics medicine
    member memory minister mobile modern money mountain museum music nature network news north novel nursery office online orchestra
    painting paper parent park partner people philosophy photo physics planet poetry police policy press project public
    """.split()
)


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 to block): each word as a host of its own, with neighbours and paths as sites have them."""
    hosts = ("{}.example.com", "www.{}.example.net", "{}.example.org", "blog.{}.example.com", "m.{}-site.example.net", "my-{}.example.org")
    paths = ("/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}?page=2", "/", "/index.html")
    out = []
    for words, label in ((BLOCKED_WORDS, 1), (ALLOWED_WORDS, 0)):
        for w, word in enumerate(words):
            for i, host in enumerate(hosts):
                path = paths[(w + i) % len(paths)].format(37 * w + i)
                out.append((f"https://{host.format(word)}{path}", label))
    # Most sites are no reason to block: names of two allowed words.
    for w, word in enumerate(ALLOWED_WORDS):
        for i, host in enumerate(hosts):
            pair = word + ALLOWED_WORDS[(w * 7 + i * 11 + 5) % len(ALLOWED_WORDS)]
            out.append((f"http://{host.format(pair)}{paths[(w + 2 * i) % len(paths)].format(53 * w + i)}", 0))
    return out


# --- parts and rules ------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_parts(rule: str) -> tuple[str, str]:
    """Host and path of a rule; the path starts with the first slash."""
    host, slash, path = rule.partition("/")
    return host, slash + path


def fits(rule: str, host: Column, path: Column) -> Column:
    """The rule's host or a subdomain of it, and a path that starts with the rule's."""
    own, start = rule_parts(rule)
    return ((host == own) | host.endswith("." + own)) & path.startswith(start)


# --- regression -----------------------------------------------------------------------------


def _features(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket), each distinct n-gram of a row's host and path once; host and path n-grams differ."""
    rows, buckets = [], []
    for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        marked = (f"h^{host}$", f"p{path}")
        grams = {m[0] + m[at : at + n] for m in marked for n in NGRAMS for at in range(1, len(m) - n + 1)}
        rows += [i] * len(grams)
        buckets += [zlib.crc32(g.encode()) % BUCKETS for g in grams]
    return np.array(rows, dtype=np.int64), np.array(buckets, dtype=np.int64)


class Model:
    """Weights per bucket and a bias. A row's n-grams share one unit of length."""

    def __init__(self) -> None:
        self.weights, self.bias = np.zeros(BUCKETS), 0.0

    def logits(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        size = np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))
        return np.bincount(rows, self.weights[buckets], n) / size + self.bias

    def fit(self, hosts: Sequence[str], paths: Sequence[str], labels: Sequence[int]) -> Model:
        """Gradient descent on the mean log loss, with weight decay."""
        n, gold = len(labels), np.array(labels, dtype=np.float64)
        rows, buckets = _features(hosts, paths)
        size = np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))
        step = np.zeros(BUCKETS)
        for _ in range(EPOCHS):
            error = 1 / (1 + np.exp(-self.logits(rows, buckets, n))) - gold
            slope = np.bincount(buckets, (error / size)[rows], BUCKETS) + DECAY * n * self.weights
            step += slope**2
            self.weights -= RATE * slope / np.sqrt(step + 1e-8)
            self.bias -= RATE * error.mean()
        return self

    def score(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        rows, buckets = _features(hosts, paths)
        return 1 / (1 + np.exp(-self.logits(rows, buckets, len(hosts))))


def train(labels: DataFrame, url: str = "url", label: str = "blocked", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows of a table of labelled urls, those of least hash."""
    rows = (
        labels.filter(F.col(label).isin(0, 1) & F.col(url).isNotNull())
        .select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("host", "path"), "host", "path", "y")
        .limit(sample)
        .collect()
    )
    return Model().fit([r.host for r in rows], [r.path for r in rows], [r.y for r in rows]) if rows else Model()


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    model: Model,
    url: str = "url",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``pages`` with host, path, the fitting rule, the method's score and the verdict.

    ``rules`` are ("allow" or "block", host and path); they are configuration and become one
    expression. The longest fitting rule decides (of equally long ones the first by spelling),
    else the regression: block from ``threshold``. Urls that are null or have no ``://`` have an
    empty host and path and are scored as such. Input columns named like an added one are
    replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # fixed size: one weight per bucket

    @F.pandas_udf("double")
    def scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            yield pd.Series(shared.value.score(hosts.tolist(), paths.tolist()), dtype="float64")

    rows = drop_clashing(pages, *OUTPUT)
    parted = rows.withColumns({"host": host_of(rows[f"`{url}`"]), "path": path_of(rows[f"`{url}`"])})
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in reversed(ordered):
        here = fits(text, F.col("host"), F.col("path"))
        rule, decided = F.when(here, F.lit(text)).otherwise(rule), F.when(here, F.lit(verdict)).otherwise(decided)
    return (
        parted.withColumns({"rule": rule, "verdict": decided, "score": scores("host", "path")})
        .withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow")))
    )
