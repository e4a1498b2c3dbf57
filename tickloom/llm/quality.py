"""Quality rules: base counts of a text, and its divergence from its language's reference.

References are histograms over all documents of a language: character classes of non-space
characters, and the language's most common short words with one bin for all others. A document
fails where the Jensen-Shannon distance of either histogram to the reference of its language is
over its limit; texts too short for a stable histogram are not judged by it. A document without a
language, or of one without any document long enough to count, is held against the pooled reference.
References are a table of one row per language, joined by language: broadcast where it is small, else
dealt by language and, for languages with a large share of the documents, by a salt.

All is DataFrame functions. A null or empty text has no words, fails the base rules and is not
kept. Repeated rows each keep their row. Other columns are left out. Without documents there are no
references and no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.sources.stage import materialize

# What parts words, next to the space.
SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Character classes of non-space characters; what is left over is the last class.
CLASSES = ["[aeiou]+", "[b-df-hj-np-tv-z]+", "[A-Z]+", "[0-9]+", r"[^\x00-\x7F]+"]

MIN_WORDS = 50
REPEAT_PERCENT = 50
COMMON_WORDS = 40
COMMON_CHARS = 8
CLASS_LIMIT = 0.30
CLASS_GUARD = 200  # characters
WORD_LIMIT = 0.37
WORD_GUARD = 100  # words

BROADCAST_LANGUAGES = 4096
HOT_PARTS = 64  # a language with over this part of all documents is dealt by as many salts

_PLACE_BITS = 20
_POOLED = "\x00pooled"


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


def _texts(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text"))


def _words(rows: DataFrame) -> DataFrame:
    """Adds the words ``w``."""
    spaced = F.col("text")
    for c in SPACES:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return rows.withColumn("w", F.array_remove(F.split(spaced, " "), ""))


def _with_class_counts(df: DataFrame) -> DataFrame:
    """Step by step, so that no pattern runs twice; each works on what the ones before have left."""
    df = df.withColumn("rest0", F.array_join("w", ""))
    for i, pattern in enumerate(CLASSES):
        df = df.withColumn(f"rest{i + 1}", F.regexp_replace(f"rest{i}", pattern, ""))
    steps = [F.length(f"rest{i}").cast("long") for i in range(len(CLASSES) + 1)]
    counts = [a - b for a, b in zip(steps, steps[1:])] + [steps[-1]]
    rest = F.col(f"rest{len(CLASSES)}")
    symbols = F.length(rest) - F.length(F.translate(rest, SYMBOLS, ""))
    added = {"class_counts": F.array(*counts), "word_chars": steps[0], "n_symbols": symbols.cast("long")}
    return df.withColumns(added).drop(
        *[f"rest{i}" for i in range(len(CLASSES) + 1)]
    )


def base_counts(df: DataFrame) -> DataFrame:
    """Adds the base counts to rows with ``text`` and its words ``w``."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = _with_class_counts(df).withColumns({"n_words": F.size("w").cast("long"), "lines": lines})
    last = F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0)))
    triple = lambda x, i: (x, F.get("w", i + 1), F.get("w", i + 2))
    # Equal triples stand side by side once sorted: by hash above and place below in one number,
    # with the words compared after; texts with more places than fit sort by the words themselves.
    marked = F.transform(
        last, lambda x, i: F.shiftleft(F.xxhash64(*triple(x, i)), _PLACE_BITS).bitwiseOR(i.cast("long"))
    )
    few = F.size("w") < 1 << _PLACE_BITS
    places = F.transform(F.sort_array(marked), lambda x: x.bitwiseAND((1 << _PLACE_BITS) - 1).cast("int"))
    exact = F.sort_array(F.transform(last, lambda x, i: F.struct(F.concat_ws(" ", *triple(x, i)).alias("t"), i.alias("at"))))
    ordered = F.when(few, places).otherwise(F.transform(exact, lambda x: x["at"]))
    df = df.withColumn("ordered", F.when(F.size("w") >= 3, ordered).otherwise(F.array().cast("array<int>")))

    def same(p: Column, other: Column) -> Column:
        q = F.get("ordered", other)
        return (
            (F.get("w", p) == F.get("w", q))
            & (F.get("w", p + 1) == F.get("w", q + 1))
            & (F.get("w", p + 2) == F.get("w", q + 2))
        )

    again = F.filter("ordered", lambda p, i: same(p, i - 1) | same(p, i + 1))
    df = df.withColumn("places", F.sort_array(again)).drop("ordered")
    fresh_words = F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3))))
    return df.withColumns(
        {
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": _total(F.transform(fresh_words, lambda x: x.cast("long"))),
        }
    ).drop("lines", "places")


def _measured(rows: DataFrame) -> DataFrame:
    """Counts of rows with words ``w``, and their words of ``COMMON_CHARS`` or less, ``short``, in place of the text.

    Written once: the references and the distances need no more of a text than this.
    """
    short = F.array_join(F.filter("w", lambda x: F.length(x) <= COMMON_CHARS), " ")
    return materialize(rows.withColumn("short", short).drop("w", "text"), "measured", compression="zstd")


def references(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    common_words: int = COMMON_WORDS,
) -> DataFrame:
    """Per language (null for the pooled one): ``documents``, ``classes``, ``words`` and ``word_shares``.

    Histograms of all documents; one row of ``common_words`` short words per language, and the pool's.
    """
    rows = _with_class_counts(_words(_texts(df, id_col, text_col, lang_col)))
    return _references(_measured(rows.withColumn("n_words", F.size("w").cast("long"))), common_words)


def _references(rows: DataFrame, common_words: int) -> DataFrame:
    """The same from measured rows."""
    rows = rows.where(F.col("n_words") >= MIN_WORDS)
    size = len(CLASSES) + 1
    sums = [F.sum(F.col("class_counts")[i]).alias(f"class{i}") for i in range(size)]
    per_language = rows.groupBy("lang").agg(F.count("*").alias("documents"), F.sum("n_words").alias("all_words"), *sums)
    per_language = materialize(per_language, "language-sums")
    named = per_language.where("lang is not null")
    totals = [F.sum(c).alias(c) for c in ("documents", "all_words", *(f"class{i}" for i in range(size)))]
    pool = per_language.agg(*totals).where("documents is not null").select(F.lit(_POOLED).alias("lang"), "*")
    wide = named.unionByName(pool)
    counts = (
        rows.select("lang", F.explode(F.array_remove(F.split("short", " "), "")).alias("word"))
        .groupBy("lang", "word")
        .count()
    )
    counts = materialize(counts, "word-counts")
    pooled_counts = counts.groupBy("word").agg(F.sum("count").alias("count"))
    both = counts.where("lang is not null").unionByName(pooled_counts.withColumn("lang", F.lit(_POOLED)))
    # A rank window over few rows: ties are settled by the word.
    order = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    best = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= common_words)
    words = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "count"))).alias("best"))
    joined = wide.join(words, "lang", "left")
    best = F.coalesce("best", F.array().cast("array<struct<rank:int,word:string,count:bigint>>"))
    chars = sum(F.col(f"class{i}") for i in range(size))
    shares = F.transform(best, lambda x: x["count"] / F.col("all_words"))
    return joined.select(
        F.when(F.col("lang") != _POOLED, F.col("lang")).alias("lang"),
        "documents",
        F.array(*[F.col(f"class{i}") / chars for i in range(size)]).alias("classes"),
        F.transform(best, lambda x: x["word"]).alias("words"),
        F.concat(
            shares,
            F.array((F.col("all_words") - _total(F.transform(best, lambda x: x["count"]))) / F.col("all_words")),
        ).alias("word_shares"),
    )


def _share_term(a: Column, b: Column) -> Column:
    return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of two histograms of shares."""
    terms = F.zip_with(p, q, lambda a, b: _share_term(a, b) + _share_term(b, a))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def _with_references(rows: DataFrame, found: DataFrame, broadcast: int) -> DataFrame:
    """Adds the reference of each row's language, or else the pooled one."""
    pool = found.where("lang is null").first()
    pool = pool or {"classes": [1.0] + [0.0] * len(CLASSES), "words": [], "word_shares": [1.0], "widest": 0}
    kinds = {"classes": "array<double>", "words": "array<string>", "word_shares": "array<double>", "widest": "int"}
    pooled = {c: F.lit(pool[c]).cast(kind) for c, kind in kinds.items()}
    named = found.where("lang is not null").select("lang", "documents", *kinds)
    if named.count() <= broadcast:
        joined = rows.join(F.broadcast(named.drop("documents")), "lang", "left")
    else:
        # Bounded: fewer than HOT_PARTS languages can have over that part of the documents.
        hot = [r["lang"] for r in named.where(F.col("documents") * HOT_PARTS > pool["documents"]).collect()]
        is_hot = F.col("lang").isin(hot)
        salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
        parts = named.drop("documents").withColumn("salt", F.explode(salts))
        salt = F.pmod(F.xxhash64("doc_id", "short"), F.lit(HOT_PARTS)).cast("int")
        spread = rows.withColumn("salt", F.when(F.col("lang").isNull() | is_hot, salt).otherwise(0))
        joined = spread.join(parts, ["lang", "salt"], "left").drop("salt")
    return joined.withColumns({c: F.coalesce(c, v) for c, v in pooled.items()})


def _against_references(df: DataFrame) -> DataFrame:
    """Adds ``class_distance`` and ``word_distance``, null where the guards do not hold."""
    # Common words are counted by what taking each out of the joined short words leaves.
    short = F.filter(F.split("short", " "), lambda x: F.octet_length(x) <= F.col("widest"))
    df = df.withColumn("joined", F.concat(F.lit(" "), F.array_join(short, "  "), F.lit(" "))).drop("short", "widest")
    size = F.octet_length("joined")
    without = lambda x: F.octet_length(F.replace("joined", F.concat(F.lit(" "), x, F.lit(" ")), F.lit("")))
    common = F.transform("words", lambda x: F.floor((size - without(x)) / (F.octet_length(x) + 2)))
    df = df.withColumn("common", common).drop("joined")
    word_shares = F.concat(
        F.transform("common", lambda n: n / F.col("n_words")),
        F.array((F.col("n_words") - _total(F.col("common"))) / F.col("n_words")),
    )
    class_shares = F.transform("class_counts", lambda n: n / F.col("word_chars"))
    return df.withColumns(
        {
            "class_distance": F.when(F.col("word_chars") >= CLASS_GUARD, divergence(class_shares, F.col("classes"))),
            "word_distance": F.when(F.col("n_words") >= WORD_GUARD, divergence(word_shares, F.col("word_shares"))),
        }
    )


def quality(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    class_limit: float = CLASS_LIMIT,
    word_limit: float = WORD_LIMIT,
    broadcast_languages: int = BROADCAST_LANGUAGES,
) -> DataFrame:
    """Base counts, both distances and the verdict ``kept`` of every document."""
    # The longest word in bytes is written as well, or each of a text's words would find it again.
    widest = F.aggregate("words", F.lit(0), lambda a, x: F.greatest(a, F.octet_length(x)))
    measured = _measured(base_counts(_words(_texts(df, id_col, text_col, lang_col))))
    found = materialize(_references(measured, COMMON_WORDS).withColumn("widest", widest), "references")
    rows = _against_references(_with_references(measured, found, broadcast_languages))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= class_limit) & (
        F.coalesce("word_distance", F.lit(0.0)) <= word_limit
    )
    counts = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    verdict = [failed.alias("base_failed"), (~failed & near).alias("kept")]
    # Through a generator, so that filters on the verdict are not pushed down as copies of all of it.
    result = F.struct(*counts, *verdict, "class_distance", "word_distance")
    return rows.select(F.explode(F.array(result)).alias("row")).select("row.*")
