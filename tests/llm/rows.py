"""Small inputs with every awkward case, and helpers to read results."""

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sig tau ups".split()
LONG = " ".join(WORDS[i * i % 20] + str(i % 97) for i in range(30_000))
PASSAGE = "the quick brown fox jumps over the lazy dog while nine old owls watch from a quiet oak tree"

EDGE = [
    (1, PASSAGE, "x", 0.5),
    (2, None, "x", 0.5),
    (3, "", None, 0.5),
    (4, PASSAGE, "x", None),
    (5, LONG, "x", 0.5),
    (6, " \t\n\x0b ", "x", 0.5),
    (7, "Ünï çödé 漢字 " + PASSAGE + "!", "x", 0.5),
    (7, "Ünï çödé 漢字 " + PASSAGE + "!", "x", 0.5),
    (None, "no id " + PASSAGE, "x", 0.5),
    (8, "one", "x", 0.5),
]
# Names that operators use for themselves.
COLUMNS = "doc_id long, text string, ids string, score double"


def edge(spark):
    return spark.createDataFrame(EDGE, COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def by_id(df, *columns):
    """Rows as tuples, in a fixed order."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
