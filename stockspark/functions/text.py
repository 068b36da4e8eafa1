"""Text clean-up and lexicon sentiment, evaluated inside each row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockspark.functions.binding import bind

# English stopwords, the common public list without its forms with an apostrophe: the
# clean-up takes the apostrophe out of a text first, so "dont" is no stopword. "cannot" is two of them.
STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves
he him his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most
other some such no nor not only own same so than too very s t can cannot will just don should
now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan
shouldn wasn weren won wouldn
""".split()

# Valence of each sentiment word.
LEXICON = {
    "agreement": 2.2, "attack": -2.1, "bad": -2.5, "bankruptcy": -2.6, "benefit": 2.0,
    "best": 3.2, "better": 1.9, "boost": 1.7, "breach": -1.9, "collapse": -2.2,
    "conflict": -1.3, "congestion": -1.2, "crisis": -3.1, "damage": -2.2, "delay": -1.3,
    "delayed": -0.9, "delays": -1.3, "die": -2.9, "disaster": -3.1, "disgusting": -2.4,
    "disruption": -1.5, "efficient": 1.8, "error": -1.7, "excellent": 2.7, "fail": -2.5,
    "failed": -2.3, "failure": -2.3, "faster": 1.2, "fire": -1.4, "fraud": -2.8,
    "gain": 2.4, "good": 1.9, "great": 3.1, "growth": 1.6, "halt": -1.4,
    "idiot": -2.3, "improve": 1.9, "improved": 2.1, "loser": -2.4, "loss": -1.3,
    "moron": -2.4, "outage": -1.6, "pathetic": -2.7, "positive": 2.6, "problem": -1.7,
    "profit": 1.9, "progress": 1.8, "promising": 1.7, "recovery": 1.7, "reliable": 1.9,
    "resolved": 0.7, "rest": 0.5, "rights": 0.8, "risk": -1.1, "scum": -2.6,
    "secure": 1.4, "severe": -1.6, "shortage": -1.0, "stable": 1.2, "strike": -0.5,
    "strong": 2.3, "stupid": -2.4, "success": 2.7, "successful": 2.8, "support": 1.7,
    "threat": -2.4, "trash": -1.8, "trust": 2.3, "warning": -1.4, "weak": -1.9,
    "welcome": 2.0, "win": 2.8, "worse": -2.1, "worst": -3.1, "worthless": -1.9,
}

# Words that flip, and words that strengthen or weaken, a following word.
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "didnt", "doesnt", "dont", "hadnt", "hasnt",
    "havent", "isnt", "lack", "neither", "never", "no", "none", "nor", "not", "nothing",
    "nowhere", "rarely", "seldom", "shouldnt", "wasnt", "werent", "without", "wont", "wouldnt",
)
STRENGTHEN = ("absolutely", "completely", "extremely", "highly", "most", "really", "so", "totally", "very")
WEAKEN = ("almost", "barely", "hardly", "partly", "slightly", "somewhat")
NEGATION_FACTOR = -0.74
BOOST = 0.293
BOOST_BY_DISTANCE = (1.0, 0.95, 0.9)
NORMALISER = 15.0
POSITIVE_FROM, NEGATIVE_TO = 0.05, -0.05


# The characters kept in words and the characters that separate words.
SPACE_CLASS = r"\s\p{Z}\x0B\x1c-\x1f\x85"
WORD_CLASS = r"\p{L}\p{N}_"


def words(text: Column) -> Column:
    """Lower-cased words; every character that is neither word character nor space is dropped."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"[^{WORD_CLASS}{SPACE_CLASS}]", "")
    # One plain space between words lets the split work without a pattern.
    spaced = F.trim(F.regexp_replace(bare, f"[{SPACE_CLASS}]+", " "))
    return F.filter(F.split(spaced, " "), lambda word: word != "")


def content_words(text: Column) -> Column:
    """Words that are purely alphabetic and not stopwords."""
    return F.filter(words(text), lambda word: word.rlike(r"^\p{L}+$") & ~word.isin(*STOPWORDS))


def normalise(text: Column) -> Column:
    return F.array_join(content_words(text), " ")


def text_choice(summary: Column, headline: Column) -> Column:
    """The summary, or the headline where the summary is missing or blank, trimmed."""
    return F.trim(F.coalesce(F.when(F.trim(summary) != "", summary), headline, F.lit("")))


def _valence(word: Column, lexicon: dict[str, float]) -> Column:
    by_value: dict[float, list[str]] = {}
    for name, value in lexicon.items():
        by_value.setdefault(value, []).append(name)
    expression = F.when(F.lit(False), F.lit(0.0))
    for value, names in by_value.items():
        expression = expression.when(word.isin(*names), F.lit(value))
    return expression.otherwise(F.lit(0.0))


def _word_score(tokens: Column, position: Column, word: Column, lexicon: dict[str, float]) -> Column:
    """Valence of one word, moved by the one to three words in front of it."""
    valence = _valence(word, lexicon)
    shift, negated = F.lit(0.0), F.lit(False)
    for distance, weight in enumerate(BOOST_BY_DISTANCE, start=1):
        before = F.when(position >= distance, F.get(tokens, position - F.lit(distance)))
        step = F.when(before.isin(*STRENGTHEN), F.lit(BOOST * weight)).when(
            before.isin(*WEAKEN), F.lit(-BOOST * weight)
        ).otherwise(F.lit(0.0))
        shift = shift + step
        negated = negated | F.coalesce(before.isin(*NEGATIONS), F.lit(False))
    boosted = F.when(valence > 0, valence + shift).otherwise(valence - shift)
    return F.when(negated, boosted * F.lit(NEGATION_FACTOR)).otherwise(boosted)


def sentiment_score(text: Column, lexicon: dict[str, float] | None = None) -> Column:
    """Compound score in (-1, 1), four decimals; 0.0 for blank text.

    Only the few words found in the lexicon are scored, and everything happens inside the row:
    no explode, no join and no shuffle, so the cost is linear in the length of the text.
    """
    table = LEXICON if lexicon is None else lexicon

    def total(tokens: Column) -> Column:
        marked = F.transform(tokens, lambda word, i: F.when(word.isin(*table), i))
        hits = F.filter(marked, lambda i: i.isNotNull())
        return F.aggregate(
            hits, F.lit(0.0), lambda acc, i: acc + _word_score(tokens, i, F.get(tokens, i), table)
        )

    return bind(
        bind(words(text), total),
        lambda s: F.round(s / F.sqrt(s * s + F.lit(NORMALISER)), 4) + F.lit(0.0),
    )


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score >= POSITIVE_FROM, "Positive")
        .when(score <= NEGATIVE_TO, "Negative")
        .otherwise("Neutral")
    )
