import pytest
import test_bpe
import test_decontam
import test_simhash
import test_suffix
from pyspark.sql import functions as F
from rows import EDGE, by_id
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm.queries import VOCABULARY, load
from tickloom.sources.stage import materialize


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output of every stage."""
    docs, out = load(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, sf_dir), name)
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(stages):
    columns = stages[0][0].columns
    assert all(after.columns == columns for _, after in stages[:-1])


def test_language_keeps_documents_with_words(stages):
    before, after = map(rows, stages[0])
    assert set(after) <= set(before) and len(after) >= 0.99 * len(before)


def test_one_document_of_each_group(stages):
    before, after = map(rows, stages[1])
    first = {i for i, _, c in test_simhash.plain_groups(before) if i == c}
    assert sorted(after) == sorted(r for r in before if r[0] in first)


def test_repeats_go(stages):
    before, after = map(rows, stages[2])
    sizes = {r[0]: r[1] - r[2] for r in test_suffix.plain(before)}
    assert {i for i, _ in after} == set(sizes)
    # A character that lost one of its bytes goes as a whole.
    assert all(0 <= sizes[i] - len(t.encode()) <= 8 * (1 + sizes[i] // 50) for i, t in after)
    texts = dict(before)
    assert all(t == texts[i] for i, t in after if sizes[i] == len(texts[i].encode()))


def test_benchmark_passages_go(spark, sf_dir, stages):
    before, after = map(rows, stages[3])
    bench = [(r["item_id"], r["text"]) for r in load(spark, sf_dir, "benchmark").collect()]
    clean = {r[0] for r in test_decontam.plain(before, bench) if not r[-1]}
    assert sorted(after) == sorted(r for r in before if r[0] in clean)


def test_tokens_and_whole_run(spark, sf_dir, stages):
    before = rows(stages[4][0])
    library = Tokenizer.from_file(VOCABULARY)
    want = sorted((i, *test_bpe.expected(library, t)) for i, t in before)
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(by_id(stages[4][1], *columns)) == want
    assert sorted(by_id(corpus_pipeline.run(spark, sf_dir), *columns)) == want


def awkward(spark, sf_dir):
    """The edge rows as documents, with columns that have names of the stages' own."""
    columns = "doc_id long, text string, lang string, source string, n_chars long, row int, fp long, mask int, key int, ids string"
    rows = [(i, t, "en", "s", len(t or ""), n, 1, 2, 3, "x") for n, (i, t, *_) in enumerate(EDGE)]
    return spark.createDataFrame(rows, columns)


@pytest.mark.parametrize("at", range(5))
def test_stages_take_awkward_and_no_rows(spark, sf_dir, at):
    name, stage = corpus_pipeline.STAGES[at]
    docs = awkward(spark, sf_dir)
    after = materialize(stage(spark, docs, sf_dir), name)
    none = stage(spark, docs.limit(0), sf_dir)
    assert none.collect() == [] and none.columns == after.columns
    if name == "tokens":
        assert after.count() == len(EDGE)
        return
    assert after.columns == docs.columns
    left = [EDGE[r["row"]] for r in after.collect()]
    if name == "language":  # no letters, no language
        assert sorted(left, key=str) == sorted((r for r in EDGE if (r[1] or "").strip()), key=str)
    elif name == "near_duplicates":
        assert sorted(left, key=str) == sorted((EDGE[i] for i in test_simhash.kept_of(EDGE)), key=str)
    elif name == "repeats":  # texts shrink, rows stay
        assert len(left) == len(EDGE)
        sizes = {r["row"]: len(r["text"] or "") for r in after.collect()}
        assert sizes[0] == len(EDGE[0][1]) and sizes[3] == 0 and sizes[4] == len(EDGE[4][1])
    else:
        assert len(left) == len(EDGE)  # the benchmark has none of them


def test_planted_documents_go_and_stay(spark, sf_dir):
    """What has no language goes, whatever it is labelled; real texts stay, unlabelled and very long ones too."""
    docs = load(spark, sf_dir, "documents")
    texts = [r["text"] for r in docs.where("length(text) > 200").orderBy("doc_id").limit(3).collect()]
    bad = [None, "", " \n\t ", "12345 67890 -- 3.14", "!!! ??? ..."]
    good = [texts[0], texts[1] * 300, texts[2].upper()]
    planted = spark.createDataFrame(
        [(10_000_000 + i, t, "en" if i % 2 else None, "x", len(t or "")) for i, t in enumerate(bad + good)], docs.schema
    )
    kept = corpus_pipeline.STAGES[0][1](spark, docs.unionByName(planted), sf_dir).where(F.col("doc_id") >= 10_000_000)
    assert sorted(r["doc_id"] - 10_000_000 for r in kept.select("doc_id").collect()) == [5, 6, 7]
