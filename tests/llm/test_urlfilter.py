import hashlib
import math
import random
import re
from collections import Counter

import pytest

from tickloom.llm import urlfilter
from tickloom.llm.queries import load, op13_urls

COLUMNS = ["page_id", "host", "path", "rule", "verdict"]
LOWER = {c: c + 32 for c in range(65, 91)}


def parts(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


def rule_of(host, path):
    fits = [
        (len(h + p), h + p, v) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def symbol(c):
    if c in "./":
        return {".": 27, "/": 28}[c]
    if c in "0123456789":
        return 29
    if c in "-?=&_%":
        return 30
    return ord(c) & 31 if "a" <= c <= "z" else 31


class Model:
    """Counts of contexts of every length, and probabilities by recursion."""

    def __init__(self, texts):
        self.counts = Counter()
        for text in texts:
            for i in range(len(text)):
                whole = ([0] * 3 + text)[i : i + 4]
                for k in range(4):
                    self.counts[tuple(whole[3 - k :])] += 1
        self.after = {}
        for place, n in self.counts.items():
            total, kinds = self.after.get(place[:-1] + (len(place),), (0, 0))
            self.after[place[:-1] + (len(place),)] = (total + n, kinds + 1)

    def p(self, place):
        lower = self.p(place[1:]) if len(place) > 1 else 1 / 32
        total, kinds = self.after.get(place[:-1] + (len(place),), (0, 0))
        return (self.counts[place] + kinds * lower) / (total + kinds) if total else lower


def plain(rows):
    """Rules, models and limit in plain code."""
    urls = []
    for page_id, url, *_ in rows:
        host, path = parts(url)
        held = hashlib.sha256((url or "").encode()).hexdigest()[0] < "4"
        urls.append((page_id, host, path, *rule_of(host, path), held, [symbol(c) for c in (host + path).translate(LOWER)]))
    good, bad = (Model([u[6] for u in urls if u[4] == v and not u[5]]) for v in ("allow", "block"))
    scores = []
    for u in urls:
        places = [tuple(([0] * 3 + u[6])[i : i + 4]) for i in range(len(u[6]))]
        scores.append(sum(math.log(good.p(p) / bad.p(p)) for p in places) / len(places) if places else None)
    sides = []
    for v in ("allow", "block"):
        own = [s for u, s in zip(urls, scores) if u[4] == v and u[5] and s is not None]
        mean = sum(own) / len(own) if own else None
        sides.append((mean, math.sqrt(sum((s - mean) ** 2 for s in own) / len(own)) if own else None))
    (ma, sa), (mr, sr) = sides
    limit = None
    if ma is not None and mr is not None:
        limit = (ma * sr + mr * sa) / (sa + sr) if sa + sr > 0 else (ma + mr) / 2
    out = []
    for u, s in zip(urls, scores):
        below = limit is not None and s is not None and s < limit
        out.append((*u[:4], u[4] or ("block" if below else "allow")))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


EDGE = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://EXAMPLE.net/EN/x"), (6, "http://a.example.net/en/x?y://z.org/fr/"),
    (7, "ftp://xexample.net/en/"), (8, "http://net"), (9, "http://net/"), (10, "http://org/fr/#a"), (10, "http://org/fr/#a"),
    (None, "https://u:p@Ünï.example.com:80/de/ü"), (11, "http://a.example.com/de"), (12, "http://q.test/\n/line`{|}~\x7f"),
    (13, "http://long.test/" + "abc/9-" * 20_000), (14, "://h.org/fr/1"), (15, "x://y://net/"),
]


def test_edge_rows(spark):
    rng = random.Random(3)
    rows = [(100 + i, f"http://h{rng.choice('abc')}.{rng.choice(['example.net', 'example.com', 'x.org'])}/{rng.choice(['en', 'de', 'fr'])}/{i}") for i in range(200)]
    rows += EDGE
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "page_id long, url string, code int, held string, score double")
    assert got(urlfilter.judge(df)) == plain(rows)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in load(spark, sf_dir, "pages").select("page_id", "url").collect()]
    assert got(op13_urls(spark, sf_dir)) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "http://a.test/x"), (2, "http://b.net/y")]])
def test_nothing_to_learn_from(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string")
    assert got(urlfilter.judge(df)) == plain(rows)


def test_built_in_functions_only(spark, sf_dir):
    plan = op13_urls(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
