"""URL filter: longest host and path rule, else a logistic regression on hashed character n-grams, in SQL functions only.

The regression has a weight for each bucket of host and of path n-grams. It is trained on a small table of labelled
URLs, on the driver; its size is fixed by BUCKETS, so it travels as one literal. Weights are whole numbers (1 / SCALE), so sums do not depend on their order and
every engine gets the same verdict. Rows are independent: there is no shuffle.

Defined results: a null url and one without `://` have an empty host and path, fit no rule and are judged by the regression's
constant alone; repeated rows get equal results. Other columns are passed through; host, path, rule, score, verdict
replace columns of these names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from floegrid.llm.tables import passing_through

BUCKETS = 2048
SIZES = (2, 3, 4)
SCALE = 1 << 16
MAX_LABELLED = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the contract (host, path), and whether they block.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

# A small labelled table: 1 is unwanted (trackers, sign-up and shop pages, adult and gambling hosts, link farms).
LABELLED = [
    ("https://www.example.org/en/article/12", 0), ("https://news.example.com/en/2021/05/city-council", 0),
    ("http://blog.example.org/fr/notes/7", 0), ("https://docs.example.com/guide/install.html", 0),
    ("https://wiki.example.org/wiki/Harbour", 0), ("https://library.example.edu/catalogue/item/44", 0),
    ("https://museum.example.org/es/exhibits/3", 0), ("http://www.example.edu/physics/lecture-9.html", 0),
    ("https://m.example.com/en/story/881", 0), ("https://science.example.org/papers/ice-cores", 0),
    ("https://forum.example.org/thread/1932", 0), ("https://www.example.com/recipes/rye-bread", 0),
    ("https://travel.example.com/en/norway/fjords/", 0), ("http://history.example.edu/archive/1890.html", 0),
    ("https://www.example.com/en/7198", 0), ("https://blog.example.com/en/853/", 0),
    ("https://city.example.org/de/transport/plan", 0), ("https://poems.example.org/read/15", 0),
    ("https://code.example.com/tutorial/sorting.html", 0), ("https://school.example.edu/biology/cells", 0),
    ("http://ads.example.com/click?id=9", 1), ("https://track.example.com/pixel.gif", 1),
    ("https://www.casino-bonus.example.com/slots/free-spins", 1), ("http://cheap-pills.example.com/buy/now", 1),
    ("https://adult-video.example.com/watch/88", 1), ("http://xxx.example.org/cams/live", 1),
    ("https://login.example.com/signup/register", 1), ("https://shop.example.com/cart/checkout", 1),
    ("http://best-loans.example.com/apply/fast-cash", 1), ("https://poker.example.com/bet/odds", 1),
    ("https://free-download.example.com/crack/serial-key", 1), ("http://click.example.org/redirect/out", 1),
    ("https://win-prize.example.com/lottery/claim", 1), ("https://ads.example.org/banner/728x90", 1),
    ("http://seo-links.example.com/tag/backlinks/buy", 1), ("https://coupons.example.com/deal/discount-code", 1),
    ("https://www.betting.example.com/sports/odds", 1), ("https://dating.example.com/hot-singles", 1),
    ("http://porn.example.com/tube/video", 1), ("https://track.example.org/beacon/collect", 1),
]


def host_path_of(url: str) -> tuple[str, str]:
    """Host and path by the same rule as `host_of` and `path_of`."""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return rest[:end].translate(str.maketrans(UPPER, LOWER)), tail[:stop]


def bucket(gram: str, salt: int) -> int:
    """A polynomial over code points that every engine can compute in whole numbers."""
    h = salt
    for c in gram:
        h = (h * 1009 + ord(c)) % 1_000_003
    return h % BUCKETS


def grams_of(host: str, path: str) -> list[int]:
    return [bucket(s[i:i + n], salt + n) for salt, s in ((11, host), (29, path)) for n in SIZES
            for i in range(len(s) - n + 1)]


def train(labelled: Sequence[tuple[str, int]] = LABELLED, epochs: int = 60, rate: float = 0.5,
          decay: float = 1e-3) -> tuple[int, list[int]]:
    """Constant and weights, in units of 1 / SCALE. The score of a URL is the sum over its n-grams."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"at most {MAX_LABELLED} labelled urls are fitted on the driver")
    rows = [(grams_of(*host_path_of(u)), y) for u, y in labelled if u is not None]
    bias, weights, seen = 0.0, [0.0] * BUCKETS, [1e-3] * BUCKETS
    for _ in range(epochs):
        for grams, y in rows:
            margin = bias + sum(weights[b] for b in grams)
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, margin)))) - y
            bias -= 0.05 * error
            for b in set(grams):
                g = error * grams.count(b) + decay * weights[b]
                seen[b] += g * g
                weights[b] -= rate * 0.1 * g / math.sqrt(seen[b])
    return round(bias * SCALE), [round(w * SCALE) for w in weights]


def train_on(labelled: DataFrame, url: str = "url", label: str = "label") -> tuple[int, list[int]]:
    """Train on a small labelled table; a table of more than MAX_LABELLED rows is refused."""
    rows = labelled.where(F.col(url).isNotNull() & F.col(label).isNotNull()).select(url, label).limit(MAX_LABELLED + 1).collect()
    return train(sorted((r[0], int(r[1])) for r in rows))


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.substring_index(F.substring_index(_rest(url), "/", 1), "?", 1), "#", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first `://`; null without one."""
    return F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))


def path_of(url: Column) -> Column:
    host = F.substring_index(F.substring_index(F.substring_index(_rest(url), "/", 1), "?", 1), "#", 1)
    tail = F.substr(_rest(url), F.length(host) + 1)
    return F.coalesce(F.substring_index(F.substring_index(tail, "?", 1), "#", 1), F.lit(""))


def _let(value: Column, then) -> Column:
    return F.transform(F.array(value), then)[0]


def _gram_weights(points: Column, first: int, size: int, weights: str) -> Column:
    """Sum of the weights of all n-grams of one size."""
    def add(total: Column, i: Column) -> Column:
        h = F.lit(first).cast("long")
        for k in range(size):
            h = (h * 1009 + F.get(points, i + k)) % 1_000_003
        return total + F.get(F.col(weights), (h % BUCKETS).cast("int"))
    at = F.when(F.size(points) >= size, F.sequence(F.lit(0), F.size(points) - size)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(at, F.lit(0).cast("long"), add)


def _part_score(points: Column, salt: int, weights: str) -> Column:
    """Sum of the weights of a part's n-grams of all sizes. points: its code points."""
    return sum((_gram_weights(points, salt + n, n, weights) for n in SIZES), F.lit(0).cast("long"))


def _points(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


@passing_through("_url", "_w")
def filter_urls(pages: DataFrame, url: str = "url", model: tuple[int, list[int]] | None = None,
                rules: Sequence[tuple[str, str, str]] = tuple(RULES)) -> DataFrame:
    """`pages` with host, path, rule (null if none fits), score (in units of 1 / SCALE) and verdict (allow or block)."""
    bias, weights = model or train()
    made = ["host", "path", "rule", "score", "verdict"]
    link = F.col("_url")
    split = (pages.withColumn("_url", F.col(url)).drop(*made).withColumns({"host": host_of(link), "path": path_of(link)}).drop("_url"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((F.col("host") == h) | F.endswith(F.col("host"), F.lit(f".{h}"))) & F.startswith(F.col("path"), F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    table = F.from_json(F.lit("[" + ",".join(map(str, weights)) + "]"), "array<long>")
    score = (_let(_points(F.col("host")), lambda p: _part_score(p, 11, "_w"))
             + _let(_points(F.col("path")), lambda p: _part_score(p, 29, "_w")) + bias)
    return (split.withColumn("_w", table).withColumns({"rule": rule, "score": score}).drop("_w")
            .withColumn("verdict", F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow"))))
