"""Language identification and toxicity: held-out accuracy on the given tables, awkward rows."""

from cases import AWKWARD, frame
from pyspark.sql import functions as F

from stockspark.llm import language, toxicity
from stockspark.llm.common import fold_of, table
from stockspark.llm.queries import op3_language_id, op9_toxicity

SF = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    found = op3_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 250 and right >= 0.97 * total
    assert found.where("score < 0 OR score > 1").count() == 0


def test_language_of_awkward_rows(spark):
    df = frame(spark, [*AWKWARD, (60, "le chat est sur la table avec une fleur"), (61, "the cat is on the table with a flower"), (62, "die katze ist auf dem tisch")], clash=("__language", "score2"))
    rows = [(t, g) for t, g in (("le la les une des avec sur est", "fr"), ("the of and with on is to that", "en"), ("der die das und ist auf mit dem", "de")) for _ in range(3)]
    model = language.fit(rows)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(df, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (0, 1, 2, 3))
    assert [got[i][0] for i in (60, 61, 62)] == ["fr", "en", "de"]
    assert language.identify(frame(spark, []), model).count() == 0
    assert model.families == {"germanic": ["de", "en"], "romance": ["fr"]}


def test_models_with_few_languages():
    assert language.fit([]).predict("abc") == ("und", 0.0)
    assert language.fit([("abc", "xx"), (None, "yy"), ("12", "zz")]).predict("abc") == ("xx", 1.0)


def test_prediction_ignores_other_columns(spark):
    model = language.fit([("the of and", "en"), ("der die das", "de")])
    a = language.identify(frame(spark, [(1, "the and")]), model).first()
    b = language.identify(frame(spark, [(77, "the and")], clash=("x",)).withColumn("lang", F.lit("de")), model).first()
    assert (a["lang_pred"], a["score"]) == (b["lang_pred"], b["score"])


def test_training_leaves_the_held_out_fold(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    texts = {r[0] for r in docs.where(fold_of(F.col("doc_id"), 3) != 1).select("text").collect()}
    rows = language.training_rows(docs, per_language=50)
    assert rows and {t for t, _ in rows} <= texts and rows == language.training_rows(docs.repartition(7), per_language=50)


def test_toxicity_of_held_out_documents(spark):
    found = op9_toxicity(spark, SF).join(table(spark, SF, "labels").select("doc_id", "toxic"), "doc_id").where("held_out")
    rows = found.select("toxic", "predicted").collect()
    caught = sum(r["predicted"] for r in rows if r["toxic"])
    false = sum(r["predicted"] for r in rows if not r["toxic"])
    assert caught >= 0.6 * sum(r["toxic"] for r in rows) and false <= 0.05 * len(rows)


def test_folding():
    assert toxicity.fold("Th1s iѕ an id10t, an ID|OT!") == " this is an idiot an idiot "
    assert toxicity.fold("a$$ $5") == " a s " or toxicity.fold("p@th3t1c") == " pathetic "
    assert toxicity.fold("ｆｕｌｌ ​wi​dth") == " full width "
    assert toxicity.fold("") == "  "


def test_lexicon_learned_from_rows(spark):
    clean = [(i, f"good calm words number w{i % 7} of the day in town", 0) for i in range(80)]
    clean += [(500 + i, "the clownfish swims and clown shoes are funny", 0) for i in range(20)]
    toxic = [(1000 + i, f"good words you clown of w{i % 7} stup1d day", 1) for i in range(40)]
    sample = spark.createDataFrame(clean + toxic, "doc_id bigint, text string, label int")
    lexicon = toxicity.learn(sample)
    assert lexicon.score("what a STUP1D thing") > 0.5 > lexicon.score("a calm day in town")
    assert lexicon.score("clown shoes") < lexicon.score("you clown")
    df = frame(spark, AWKWARD, clash=("label", "weight"))
    got = toxicity.rate(df, lexicon).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    lowest = lexicon.score("")
    assert {r["score"] for r in got if r["doc_id"] in (0, 1, 2)} == {lowest}
    assert toxicity.rate(frame(spark, []), lexicon).count() == 0


def test_no_labels_of_one_kind(spark):
    one = spark.createDataFrame([(1, "a b c d", 0)], "doc_id bigint, text string, label int")
    assert toxicity.learn(one).score("anything") < 0.1
    assert toxicity.learn(one.limit(0)).score(None) < 0.1
