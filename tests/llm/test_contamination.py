"""Decontamination against a plain search for all windows."""

from cases import AWKWARD, SF, frame, real_rows
from pyspark.sql import Row

from stockspark.llm import contamination
from stockspark.llm.contamination import words_of


def plain(docs, items):
    windows = {}
    for i, t in items:
        w = words_of(t)
        for at in range(max(0, len(w) - min(10, len(w)) + 1) if w else 0):
            windows.setdefault(tuple(w[at : at + 10]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in docs:
        w = words_of(t)
        hit, found = set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (key := tuple(w[at : at + n])) in windows:
                    hit |= set(range(at, at + n))
                    found |= windows[key]
        out.append((-99 if i is None else i, len(w), len(hit), sorted(found)))
    return sorted(out)


def check(spark, docs, items):
    df = frame(spark, docs, clash=("row", "h", "body", "length", "item_id"))
    bench = spark.createDataFrame([Row(item_id=i, text=t, words="x") for i, t in items], "item_id bigint, text string, words string")
    got = sorted((-99 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in contamination.scan(df, bench).collect())
    assert got == plain(docs, items)


def test_real_documents(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    check(spark, [(r[0], r[1]) for r in real_rows()], items)


def test_awkward_rows_and_items(spark):
    items = [(1, "the cat sat"), (2, None), (3, ""), (4, "Word"), (5, "THE CAT, sat on the mat and looked at the dog the cat"), (None, "x y"), (7, "ünïcödé 文字"), (7, "a" * 5000), (8, "the the")]
    check(spark, [*AWKWARD, (20, "the cat the cat sat the the the cat sat on"), (21, "CAT sat on the mat AND looked at the dog the cat sat")], items)


def test_empty_tables(spark):
    assert contamination.scan(frame(spark, []), spark.createDataFrame([], "item_id bigint, text string")).count() == 0
    got = contamination.scan(frame(spark, AWKWARD), spark.createDataFrame([], "item_id bigint, text string"))
    assert got.where("n_hit > 0").count() == 0 and got.count() == len(AWKWARD)


def test_clean_keeps_all_columns(spark):
    df = frame(spark, [(1, "a b c d"), (2, "e f g"), (None, "a b c")], clash=("row",))
    kept = contamination.clean(df, spark.createDataFrame([(1, "b c")], "item_id bigint, text string"))
    assert kept.columns == df.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_clean_rows_stay_beside_contaminated_ones_of_the_same_id(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(None, f"x {item} y"), (None, "clean and without an id"), (5, item), (5, "clean under a repeated id"), (6, None)]
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    kept = {(r["doc_id"], r["text"]) for r in contamination.clean(frame(spark, rows), items).collect()}
    assert kept == {rows[1], rows[3], rows[4]}
