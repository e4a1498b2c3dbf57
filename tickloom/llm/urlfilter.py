"""URL filter by rules, and by the ratio of two character models where no rule fits.

Two smoothed Markov models, of the URLs that the rules allow and of those that they block, tell how
likely each next character is after the up to three before it; a context that was never seen falls
back on the shorter one. A URL is blocked if its mean log ratio a character lies on the blocked side
of a limit, which is set on ruled URLs that the models have not learned from.

Characters are folded to 32 symbols, so both models together are a table of 2 ** 20 log ratios at
most, whatever the data; a context and its next symbol are a place in it. Built-in functions only.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.sources.stage import materialize

# The rules as given, as verdict, host and path.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

ORDER = 3
BITS = 5
SYMBOLS = 1 << BITS

# Symbols are the low bits of a character: letters are 1 to 26 already, 0 is before the start.
_PUNCTUATION, _STANDS_FOR = "./-?=&_%0123456789", "{|~~~~~~}}}}}}}}}}"
_OTHER = "\x7f"

# URLs whose SHA-256 begins below this are not learned from but set the limit.
CALIBRATION = "4"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = F.col("host")
        whole = (host == self.host) | F.endswith(host, F.lit(f".{self.host}"))
        return whole & F.startswith(F.col("path"), F.lit(self.path))


def ordered(rules) -> list[Rule]:
    """Longest first, so that the first that fits wins."""
    return sorted((Rule(*r) for r in rules), key=lambda r: (-len(r.text), r.text))


def with_parts(df: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """``page_id``, ``url``, ``host`` in lower case (A-Z) and ``path``; both empty without ``://``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    # (?s) since a line break in a URL is a character like others.
    parts = "(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return df.select(
        F.col(id_col).alias("page_id"),
        url.alias("url"),
        F.translate(F.regexp_extract(url, parts, 1), upper, upper.lower()).alias("host"),
        F.regexp_extract(url, parts, 2).alias("path"),
    )


def with_rule(parts: DataFrame, rules) -> DataFrame:
    """The longest fitting rule's text and verdict; both null where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(ordered(rules)):
        text = F.when(r.fits(), r.text).otherwise(text)
        verdict = F.when(r.fits(), r.verdict).otherwise(verdict)
    return parts.withColumns({"rule": text, "ruled": verdict})


def codes() -> Column:
    """For each character of host and path, the places of it and the ``ORDER`` before it.

    A place is a number of one symbol per ``BITS`` bits, the latest lowest, so a shorter context's
    place is the low bits of a longer one's.
    """
    lower = F.translate(F.concat("host", "path"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # Characters that stand for symbols are no part of what is kept of the text.
    plain = F.regexp_replace(lower, "[^a-z0-9./?=&_%-]", _OTHER)
    symbols = F.transform(
        F.filter(F.split(F.translate(plain, _PUNCTUATION, _STANDS_FOR), ""), lambda c: c != ""),
        lambda c: F.ascii(c).bitwiseAND(SYMBOLS - 1),
    )
    zero = F.array_repeat(F.lit(0), ORDER)
    # The symbols are bound by a lambda of their own, so that they are made once a text.
    return F.transform(
        F.array(F.concat(zero, symbols)),
        lambda s: F.transform(
            F.slice(s, ORDER + 1, F.size(s)),
            lambda c, i: sum(
                (F.call_function("shiftleft", F.get(s, i + (ORDER - k)), F.lit(BITS * k)) for k in range(1, ORDER + 1)), c
            ),
        ),
    )[0]


def _level(occurring: DataFrame, order: int, shorter: DataFrame | None) -> DataFrame:
    """Probability of each occurring symbol after its context of this length in both models.

    The counts of a context are mixed with the shorter context's probabilities, as many parts as it
    has different successors; the shortest mixes with equal parts of all symbols.
    """
    place = F.col("code").bitwiseAND((1 << BITS * (order + 1)) - 1)
    table = occurring.groupBy(place.alias("code")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    context = Window.partitionBy(F.shiftright("code", BITS))
    if shorter is None:
        table = table.withColumns({"pa": F.lit(1.0 / SYMBOLS), "pr": F.lit(1.0 / SYMBOLS)})
    else:
        low = F.col("code").bitwiseAND((1 << BITS * order) - 1).alias("low")
        table = table.select("*", low).join(shorter.withColumnRenamed("code", "low"), "low")
    for c in ("a", "r"):
        kinds = F.sum((F.col(c) > 0).cast("long")).over(context)
        total = F.sum(c).over(context)
        p = F.when(total > 0, (F.col(c) + kinds * F.col(f"p{c}")) / (total + kinds)).otherwise(F.col(f"p{c}"))
        table = table.withColumn(f"q{c}", p)
    return table.select("code", F.col("qa").alias("pa"), F.col("qr").alias("pr"))


def ratios(occurring: DataFrame) -> DataFrame:
    """Log of the allowed over the blocked model's probability of every place that occurs.

    ``occurring`` has ``code``, ``a`` and ``r``: how often a place is in allowed and blocked URLs
    that are learned from, zero where it is only in others.
    """
    level = None
    for order in range(ORDER + 1):
        level = _level(occurring, order, level)
    return level.select("code", F.log(F.col("pa") / F.col("pr")).alias("ratio"))


def judge(df: DataFrame, *, rules=tuple(RULES), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Host, path, rule and verdict of every URL, and the score of the models.

    A null URL has no host, path and rule and a score of null, as has one without ``://``; such
    URLs are allowed, as all unruled ones are where rules have allowed or blocked no URL to learn
    from. Repeated rows and ids come out as often as they go in; URLs may have any length; no other
    column is looked at. Rules are a handful: each costs a comparison a row.
    """
    parts = with_rule(with_parts(df, id_col, url_col), rules)
    own = F.substring(F.sha2("url", 256), 1, 1)
    columns = ["page_id", "host", "path", "rule", "ruled", (own < CALIBRATION).alias("held"), codes().alias("codes")]
    staged = materialize(parts.select(F.monotonically_increasing_id().alias("row_id"), *columns), "url-codes")
    learned = ~F.col("held") & F.col("ruled").isNotNull()
    uses = lambda verdict: (learned & (F.col("ruled") == verdict)).cast("long")
    occurring = (
        staged.select(F.explode("codes").alias("code"), *[F.coalesce(uses(v), F.lit(0)).alias(n) for v, n in (("allow", "a"), ("block", "r"))])
        .groupBy(F.col("code").cast("long").alias("code"))
        .agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    )
    table = materialize(ratios(materialize(occurring, "url-places")), "url-ratios")
    # At most 2 ** 20 places of sixteen bytes, so their broadcast is bounded. A row's characters
    # stay in one task and leave it as one sum.
    scores = (
        staged.select("row_id", F.size("codes").alias("n"), F.explode(F.col("codes").cast("array<long>")).alias("code"))
        .join(F.broadcast(table), "code")
        .groupBy("row_id")
        .agg((F.sum("ratio") / F.max("n")).alias("score"))
    )
    scored = materialize(staged.drop("codes").join(scores, "row_id", "left"), "url-scores")
    side = lambda verdict: F.when(F.col("ruled") == verdict, F.col("score"))
    spread = scored.where(F.col("held")).agg(
        *[f(side(v)).alias(f"{n}_{v}") for v in ("allow", "block") for n, f in (("mean", F.avg), ("sd", F.stddev_pop))]
    )
    width = F.col("sd_allow") + F.col("sd_block")
    # As many standard deviations from the one side's mean as from the other's.
    between = (F.col("mean_allow") * F.col("sd_block") + F.col("mean_block") * F.col("sd_allow")) / width
    limit = spread.select(F.when(width > 0, between).otherwise((F.col("mean_allow") + F.col("mean_block")) / 2)).scalar()
    below = F.coalesce(F.col("score") < limit, F.lit(False))
    verdict = F.coalesce("ruled", F.when(below, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
