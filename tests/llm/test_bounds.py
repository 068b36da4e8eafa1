"""Bounded draws under hot, repeated and null ids; columns whose names clash with added ones; very long texts."""

import corpus_pipeline
import numpy as np
from cases import AWKWARD, SF, frame
from pyspark.sql import functions as F

from stockspark.llm import language, licences, mixing, neardup, pii, tagger, toxicity

SCHEMA = "doc_id bigint, text string, lang string"
LONG = "the quick brown fox writes to ann.b@example.org about 10.1.2.3 now. " * 40_000


def hot_rows():
    """A third of the rows under one id, another part without an id, all with texts of their own."""
    rows = [(7, f"one hot id with the text of number {i} and mail a{i}@b.example", "en") for i in range(600)]
    rows += [(None, f"kein schluessel aber ein text mit der nummer {i} und x{i}@y.example", "de") for i in range(300)]
    return rows + [(1000 + i, f"le texte du document numero {i} avec q{i}@r.example", "fr") for i in range(900)]


def test_draws_are_bounded_under_hot_and_null_ids(spark):
    docs = spark.createDataFrame(hot_rows(), SCHEMA)
    for most in (1, 20, 100):
        rows = language.training_rows(docs, per_language=most, fold=None)
        counts = {g: sum(1 for r in rows if r[1] == g) for g in ("en", "de", "fr")}
        assert all(n <= most for n in counts.values()) and rows == language.training_rows(docs.repartition(5), per_language=most, fold=None)
        if most > 1:
            assert min(counts.values()) > most // 3
    assert len(language.training_rows(docs.union(docs).union(docs), per_language=10_000, fold=None)) == 1800
    windows = pii.training_windows(docs.select("doc_id", "text"), most_docs=10)
    assert 0 < len(windows) <= 10 * (pii.WINDOWS_PER_DOC + 1)
    labels = spark.createDataFrame([(7, 1), (7, 0), (None, 1), *[(1000 + i, i % 2) for i in range(900)]], "doc_id bigint, toxic int")
    for bound in (1, 50, 2000):
        drawn = toxicity.labelled(docs.select("doc_id", "text"), labels, lambda c: F.lit(True), bound=bound)
        assert 0 < drawn.count() <= bound and drawn.select("doc_id").distinct().count() == drawn.count()


def test_copies_of_few_texts_still_give_every_language(spark):
    docs = spark.createDataFrame([(i, f"a text of kind {i % 2}", "en") for i in range(500)] + [(900, "ein text", "de")], SCHEMA)
    assert language.training_rows(docs, per_language=3, fold=None) == [("a text of kind 0", "en"), ("a text of kind 1", "en"), ("ein text", "de")]


def test_too_many_languages_are_refused(spark):
    docs = spark.createDataFrame([(i, "abc", f"l{i}") for i in range(9)], SCHEMA)
    try:
        language.training_rows(docs, fold=None, most_languages=8)
    except ValueError:
        return
    raise AssertionError("nine languages were taken")


def test_clashing_names(spark):
    names = ("lang_pred", "score", "__masked", "__changed", "__row", "__kept", "__weight", "__source_cell", "__licences", "__base", "__sampled", "__language", "__score")
    docs = frame(spark, [*AWKWARD, (80, "Released under the MIT License.\nmail ann.b@example.org")], clash=names)
    n = len(AWKWARD) + 1
    model = language.fit([("the of and", "en"), ("der die das", "de")])
    assert {r["score"] for r in language.identify(docs, model).collect()} != {"extra"}
    assert [r["__licences"][0]["licence"] for r in licences.find(docs).where("doc_id = 80").collect()] == ["MIT"]
    assert len(pii.find(docs, None).where("doc_id = 80").first()["__base"]) == 1
    hidden = pii.mask(docs, None)
    assert hidden.columns == docs.columns and hidden.count() == n
    row = hidden.where("doc_id = 80").first()
    assert "<EMAIL>" in row["text"] and row["__masked"] == row["__changed"] == "extra"
    left = neardup.deduplicate(docs)
    assert left.columns == docs.columns and {r["__row"] for r in left.collect()} == {"extra"}
    mixed = mixing.mix(docs)
    assert mixed.count() == n and all(0 <= r["__probability"] <= 1 for r in mixed.collect())
    assert toxicity.rate(docs, toxicity.Lexicon(slopes=(0.0, 0.0, 0.0, 0.0))).where("score = 0.5").count() == n
    for _, stage in (corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[4]):
        found = stage(spark, docs, SF)
        assert found.columns[: len(docs.columns)] == docs.columns and {r["__weight"] for r in found.collect()} <= {"extra"}


def test_texts_of_megabytes(spark):
    docs = frame(spark, [(1, LONG), (2, LONG), (3, "a short text of the fox")])
    model = language.fit([("the quick brown fox", "en"), ("der die das und", "de")])
    assert {r["lang_pred"] for r in language.identify(docs, model).collect()} == {"en"}
    found = {r["doc_id"]: r["__base"] for r in pii.find(docs, None).collect()}
    assert len(found[1]) == len(found[2]) == 80_000 and found[3] == []
    tokens = {r["doc_id"]: r["__tokens"] for r in mixing.mix(docs).collect()}
    assert tokens[1] == len(LONG.split())
    assert sorted(r["doc_id"] for r in neardup.deduplicate(docs).collect()) == [1, 3]


def plain_viterbi(model, scores):
    steps, tags, _ = scores.shape
    out = np.zeros((steps, scores.shape[2]), dtype=np.uint8)
    for w in range(scores.shape[2]):
        value, back = scores[0, :, w] + model.start, []
        for t in range(1, steps):
            tried = value[:, None] + model.moves
            back.append(tried.argmax(0))
            value = tried.max(0) + scores[t, :, w]
        tag = int(value.argmax())
        out[-1, w] = tag
        for t in range(steps - 1, 0, -1):
            tag = int(back[t - 1][tag])
            out[t - 1, w] = tag
    return out


def test_best_paths_equal_plain_viterbi():
    draw = np.random.default_rng(4)

    class Random:
        pass

    for k in range(300):
        model = Random()
        model.moves = draw.normal(0, 1, (tagger.TAGS, tagger.TAGS))
        model.start = draw.normal(0, 1, tagger.TAGS)
        if k % 2:
            model.moves[0, 0] = model.moves.max() - draw.random() * 0.5
        scores = draw.normal(0, 1, (12, tagger.TAGS, 6))
        scores[:, 0] += draw.random() * 4
        assert (tagger.best_paths(model, scores) == plain_viterbi(model, scores)).all()


def test_reached_margins(spark):
    rows = [("a", "en", "prose", 100, 0.0, 0.0), ("b", "en", "prose", 300, 0.0, 0.0)]
    cells = spark.createDataFrame([r[:4] for r in rows], "__source string, __lang string, __topic string, __tokens long")
    targets = {"source": {"a": 0.75, "b": 0.25}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"prose": 1.0}}
    got = {(m, v): (t, r, d) for m, v, t, r, d in mixing.calibrate(cells, targets, rate=0.5).margins(targets)}
    assert abs(got["source", "a"][1] - 0.75) < 1e-9 and got["lang", "de"][1] == 0.0 and abs(got["lang", "en"][1] - 1.0) < 1e-9
    assert abs(got["source", "a"][2] - 0.5) < 1e-9  # the cell is kept whole and falls short
