import math
from collections import Counter

import pytest
from rows import PASSAGE, by_id

from tickloom.llm import quality
from tickloom.llm.queries import op1_quality

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
SPACES = " \t\n\x0b\x0c\r"


def plain(doc_id, text):
    text, words, word = text or "", [], ""
    for c in text + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    triples = Counter(zip(words, words[1:], words[2:]))
    again = {i + k for i in range(len(words) - 2) for k in range(3) if triples[tuple(words[i : i + 3])] > 1}
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (doc_id, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), failed)


TEXTS = [
    (1, PASSAGE * 3),
    (2, None),
    (3, ""),
    (4, "a b c a b c a b c\n\n \na b c\na b c"),
    (5, "x\x0by\x0cz # | <é漢>\r\n#\n#\n"),
    (6, " ".join(f"w{i % 61}{i}" for i in range(30_000))),
    (7, "one two three"),
    (7, "one two three"),
    (None, PASSAGE + "\xa0 1"),
]
SCHEMA = "doc_id long, text string, lang string, w string, words string"


def frame(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "en" if i != 6 else None, "x", None) for i, t in rows], SCHEMA)


def test_base_counts(spark):
    got = by_id(quality.quality(frame(spark)), *COLUMNS)
    assert got == sorted((plain(*r) for r in TEXTS), key=str)


def test_divergence_is_a_distance(spark):
    row = spark.createDataFrame([([0.5, 0.5, 0.0], [0.25, 0.25, 0.5])], "p array<double>, q array<double>")
    got = row.select(
        quality.divergence(row.p, row.q).alias("a"), quality.divergence(row.q, row.p).alias("b"), quality.divergence(row.p, row.p)
    ).first()
    m = [0.375, 0.375, 0.25]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
    want = math.sqrt((kl([0.5, 0.5, 0.0]) + kl([0.25, 0.25, 0.5])) / 2)
    assert abs(got[0] - want) < 1e-12 and got[0] == got[1] and got[2] == 0


def test_odd_text_goes_and_usual_text_stays(spark):
    usual = [(i, " ".join(PASSAGE.split()[(i + k) % 19] + str(k % 7) for k in range(150))) for i in range(40)]
    odd = (99, " ".join(f"#{k}$$ ||&&" for k in range(200)))
    short = (98, "## || $$ %% && " * 2)
    got = quality.quality(frame(spark, [*usual, odd, short]))
    kept = {r["doc_id"]: (r["kept"], r["class_distance"]) for r in got.collect()}
    assert all(kept[i][0] for i, _ in usual) and not kept[99][0] and kept[99][1] > quality.CLASS_LIMIT
    assert kept[98] == (False, None)


def test_vowels_and_consonants_are_told_apart(spark):
    usual = [(i, PASSAGE * 3) for i in range(20)]
    mashed = (99, " ".join("bcdfghjklm"[k % 5 :] for k in range(150)))
    got = quality.quality(frame(spark, [*usual, mashed]))
    row = got.where("doc_id = 99").first()
    assert row["class_distance"] > quality.CLASS_LIMIT and not row["kept"]


def test_references_have_forty_words_of_up_to_eight_characters(spark):
    text = " ".join(f"{'x' * 5}{k:03d} {'y' * 6}{k:03d}" for k in range(50))
    row = quality.references(frame(spark, [(1, text)])).where("lang = 'en'").first()
    assert len(row["words"]) == 40 and {len(w) for w in row["words"]} == {8} and len(row["classes"]) == 6


def test_every_language_has_its_reference(spark):
    # 80 languages; the last has one document, in another script.
    rows = [(2 * k + j, PASSAGE * 3, f"l{k:02d}") for k in range(79) for j in range(2)]
    rows += [(1000 + k, PASSAGE * 3, "l00") for k in range(40)] + [(2000, PASSAGE * 3, None)]
    greek = " ".join("".join(chr(0x3B1 + (7 * k + 3 * j + k * j) % 24) for j in range(3 + k % 5)) for k in range(150))
    df = spark.createDataFrame([*rows, (3000, greek, "zz")], "doc_id long, text string, lang string")
    assert quality.references(df).count() == 81
    columns = ["doc_id", "kept", "class_distance", "word_distance"]
    got = by_id(quality.quality(df), *columns)
    assert got == by_id(quality.quality(df, broadcast_languages=1), *columns)
    rare = next(r for r in got if r[0] == 3000)
    assert rare[1] and rare[2] < 1e-6 and rare[3] < 1e-6 and len(got) == len(df.collect())


def test_clean_documents_stay(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    rows = op1_quality(spark, sf_dir).join(labels, "doc_id").where("not base_failed")
    assert rows.where("kept").count() >= 0.98 * rows.count()


def test_no_python_runs(spark, sf_dir):
    plan = op1_quality(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert quality.quality(frame(spark, []).limit(0)).collect() == []


def test_texts_are_measured_once(spark, sf_dir):
    plan = op1_quality(spark, sf_dir)._jdf.queryExecution().toString()
    assert "/measured-" in plan and "regexp_replace" not in plan and "documents.parquet" not in plan


def test_words_around_the_length_of_common_ones(spark):
    # Words of eight characters count, in any script; longer ones and texts without short words do not.
    greek, long = "".join(chr(0x3B1 + k) for k in range(8)), "x" * 9
    rows = [(k, " ".join([greek] * 90 + [f"{long}{k}"] * 30), "el") for k in range(3)]
    rows += [(10, " ".join(f"{long}{k}" for k in range(120)), "el"), (11, "", "el"), (12, None, "el")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    reference = quality.references(df).where("lang = 'el'").first()
    assert reference["words"] == [greek] and reference["documents"] == 4
    assert reference["word_shares"] == pytest.approx([270 / 480, 210 / 480])
    got = {r["doc_id"]: r["word_distance"] for r in quality.quality(df).collect()}
    assert got[0] == got[1] == got[2] and 0 < got[0] < got[10] and got[11] is got[12] is None
