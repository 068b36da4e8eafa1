"""Personal data in whole texts: base patterns, and spans that a trained tagger adds.

The tagger (a character-level bidirectional LSTM with CRF transitions) learns from windows of a
bounded draw of documents in which the base patterns label the spans. It then reads every character of
every text in overlapping windows; their tags are reconciled over the whole text. Base spans always
stay; a tagged span is added where it overlaps no base span.

Everything is row by row inside the scan: long texts become many windows of one batch, a hot source
or large groups of copies change nothing, and the model is a few kilobytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructType

from stockspark.llm import tagger
from stockspark.llm.common import free_name, map_rows, small_batches, unit_hash
from stockspark.llm.patterns import KINDS, base_spans

TRAINING_DOCS = 6000
WINDOW = 64
WINDOWS_PER_DOC = 6
# What a whole token must look like to be added: an address with a sign or word for "at", four or more
# numbers with dots, 12 to 19 digits, 9 to 15 digits.
SHAPES = (
    re.compile(r"[^\s@]{1,64}(?: ?@ ?| ?[(\[]at[)\]] ?| at )[^\s@]{3,}"),
    re.compile(r"[0-9]{1,3}(?:[.:][0-9]{1,3}){3,}"),
    re.compile(r"(?:[0-9][ .-]?){12,19}"),
    re.compile(r"(?:\+|\(|00)?(?:[0-9][ ().-]{0,2}){9,15}"),
)
SPANS = "array<struct<s:int,k:int,e:int>>"
MASKS = tuple(f"<{k.upper()}>" for k in KINDS)


def training_windows(docs: DataFrame, most_docs: int = TRAINING_DOCS) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows of at most ``most_docs`` different texts, drawn by a hash of the text, with base spans.

    At most WINDOWS_PER_DOC windows around spans and one more come from a text. Copies, repeated ids and
    null ids count by their texts. Windows are cut inside the scan, so no long text is moved.
    """
    small_batches(docs.sparkSession)
    known = docs.where(F.col("text").isNotNull())
    total = known.agg(F.approx_count_distinct("text")).first()[0]
    if not total:
        return []
    draw = unit_hash(F.col("text"), F.lit(1))
    drawn = known.where(draw < min(1.0, most_docs / total)).select("text", draw.alias("draw"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"draw": batch.column(1), "windows": []}
            for text in batch.column(0).to_pylist():
                windows = []
                spans = base_spans(text)
                starts = [max(0, s - 7 - (s * 7919 + len(text)) % 24) for s, _, _ in spans[:WINDOWS_PER_DOC]]
                starts.append((len(text) * 31) % max(1, len(text) - WINDOW))
                for at in starts:
                    inside = [(max(s, at) - at, k, min(e, at + WINDOW) - at) for s, k, e in spans if s < at + WINDOW and e > at]
                    windows.append({"window": text[at : at + WINDOW], "spans": [{"s": s, "k": k, "e": e} for s, k, e in inside]})
                out["windows"].append(windows)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    spans = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
    schema = pa.schema([("draw", pa.float64()), ("windows", pa.list_(pa.struct([("window", pa.string()), ("spans", spans)])))])
    rows = (
        drawn.mapInArrow(cut, f"draw double, windows array<struct<window:string,spans:{SPANS}>>")
        .groupBy("draw").agg(F.min("windows").alias("windows")).orderBy("draw").limit(most_docs).collect()
    )
    return sorted((w["window"], [(x["s"], x["k"], x["e"]) for x in w["spans"]]) for r in rows for w in r["windows"])


def fit(docs: DataFrame, most_docs: int = TRAINING_DOCS) -> tagger.Tagger | None:
    """The trained tagger, or None where the drawn documents hold no span to learn from."""
    windows = training_windows(docs, most_docs)
    return tagger.train(windows) if any(spans for _, spans in windows) else None


def all_spans(texts: list[str | None], model: tagger.Tagger | None) -> list[tuple[list, list]]:
    """Base spans and added spans of each text; a null text counts as empty."""
    texts = [t or "" for t in texts]
    found = []
    for text, tagged in zip(texts, tagger.tag_texts(model, texts) if model else [[]] * len(texts)):
        base = base_spans(text)
        added = []
        for s, k, e in tagged:
            s, e = whole_token(text, s, e)
            if SHAPES[k].fullmatch(text, s, e) and not any(bs < e and s < be for bs, _, be in (*base, *added)):
                added.append((s, k, e))
        found.append((base, added))
    return found


def whole_token(text: str, s: int, e: int) -> tuple[int, int]:
    """The tagged span without marks at its ends, grown to the ends of the tokens it cuts."""
    while s < e and not text[s].isalnum() and text[s] not in "+(":
        s += 1
    while s < e and not text[e - 1].isalnum():
        e -= 1
    low, high = s - 64, e + 64
    while s > max(low, 0) and (text[s - 1].isalnum() or text[s - 1] == "+") and s < e:
        s -= 1
    while e < min(high, len(text)) and text[e].isalnum() and s < e:
        e += 1
    return s, e


def find(docs: DataFrame, model: tagger.Tagger | None, text: str = "text") -> DataFrame:
    """``docs`` with __base and __added, arrays of (s, k, e) sorted by start, kind, end.

    Positions are code points, ends exclusive, kinds as in KINDS. Null and empty texts have none;
    repeated rows are read alike; an empty table stays empty. Very long texts are read whole, in windows.
    Of tagged spans that overlap, the one with the lower start stays. Columns named __base or __added are
    replaced.
    """
    as_rows = lambda spans: [{"s": s, "k": k, "e": e} for s, k, e in spans]

    def run(columns: list[list]) -> list[list]:
        found = all_spans(columns[0], model)
        return [[as_rows(b) for b, _ in found], [as_rows(a) for _, a in found]]

    return map_rows(docs, [text], run, StructType.fromDDL(f"__base {SPANS}, __added {SPANS}"))


def number_of(spans: str, kind: int) -> Column:
    """How many spans of an array of (s, k, e) are of a kind."""
    # A second parameter of the function, even one with a default, would get the place in the array.
    return F.size(F.filter(spans, lambda x: x["k"] == kind)).cast("long")


def text_of(spans: Column) -> Column:
    """kind:start:end of an array of (s, k, e), comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with every span replaced by the mark of its kind; the first of overlapping spans wins."""
    if not text or not spans:
        return text
    parts, at = [], 0
    for s, k, e in sorted(spans):
        if s >= at:
            parts += [text[at:s], MASKS[k]]
            at = e
        elif e > at:
            at = e
    return "".join([*parts, text[at:]])


def mask(docs: DataFrame, model: tagger.Tagger | None) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` recounted; no row is dropped.

    Null and empty texts, and texts without a span, stay as they are, their ``n_chars`` too. Very long
    texts are read whole; repeated rows are masked alike; an empty table stays empty; all other columns
    stay, whatever their names.
    """
    new_text, changed_name = free_name(docs, "__masked"), free_name(docs, "__changed")

    def run(columns: list[list]) -> list[list]:
        made = [masked(t, [*b, *a]) for t, (b, a) in zip(columns[0], all_spans(columns[0], model))]
        return [made, [m != t for m, t in zip(made, columns[0])]]

    found = map_rows(docs, ["text"], run, StructType().add(new_text, StringType()).add(changed_name, BooleanType()))
    changed = {"text": F.col(new_text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(changed_name), F.char_length(new_text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])
