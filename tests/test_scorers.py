import re
import sys
import types

import pytest

from tweetflow.functions.scorers import (
    _LISTS_TYPE,
    Lexicon,
    in_windows,
    lexicon_model,
    lexicon_scorer,
    model_scorer,
    transformers_model,
    windowed,
)
from tweetflow.operators.throughput import scoring_throughput

WORDS = Lexicon(positive=("good", "fine"), negative=("bad",))

TEXTS = [
    "good good bad",
    "good",
    "bad",
    "bad bad good",
    "Good GOOD fine",
    "goods are not good2 or _good",
    "égood goodé good-good",
    "fine,good\nbad",
    "",
    None,
    "x" * 5000 + " good bad bad",
]


def expected(text):
    tokens = re.findall(r"[^\W\d_]+", (text or "").lower())
    pos = sum(t in WORDS.positive for t in tokens)
    neg = sum(t in WORDS.negative for t in tokens)
    scores = [("NEG", neg), ("NEU", 1), ("POS", pos)]
    ranked = sorted(scores, key=lambda s: -s[1])
    top = ranked[0][0]
    flag = int(top == "POS" or (top == "NEU" and ranked[1][0] == "POS"))
    return top, ranked[0][1] / (pos + neg + 1), flag


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")


@pytest.mark.parametrize(
    "scorer",
    [lexicon_scorer(WORDS)] + [model_scorer(lexicon_model(WORDS), n) for n in (1, 3, 32)],
    ids=["native", "model-1", "model-3", "model-32"],
)
def test_scorers_agree_with_plain_python(texts, scorer):
    scored = scorer(texts, "t", "p").orderBy("i")
    assert scored.columns == ["i", "t", "p"]
    assert [tuple(r["p"]) for r in scored.collect()] == [expected(t) for t in TEXTS]


def test_words_that_begin_like_others(spark):
    words = Lexicon(positive=("go", "good", "é"), negative=("goods", "no"))
    df = spark.createDataFrame([("go good goods gooods nogo no é éa",)], "t string")
    native = lexicon_scorer(words)(df, "t", "p").first()["p"]
    model = model_scorer(lexicon_model(words))(df, "t", "p").first()["p"]
    # go, good and é against goods and no, and the neutral vote
    assert tuple(native) == tuple(model) == ("POS", 3 / 6, 1)


def test_native_scorer_needs_no_python_worker(texts):
    plan = lexicon_scorer(WORDS)(texts, "t", "p")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_label_scores_and_flag_share_one_model_call(texts):
    scored = model_scorer(lexicon_model(WORDS))(texts, "t", "p").select("p.label", "p.score", "p.binary")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_model_results_leave_python_as_plain_lists(texts):
    scored = model_scorer(lambda: lambda given: [None if t == "" else [{"label": t, "score": 1.0}] for t in given])
    assert [f.dataType.simpleString() for f in _LISTS_TYPE] == ["array<string>", "array<double>"]
    got = {r.i: r.p for r in scored(texts, "t", "p").collect()}
    assert got[1].label == "good" and got[1].score == 1.0 and got[8].label is None and got[8].score is None


@pytest.mark.parametrize(
    "positive, negative",
    [(("a", "b"), ("b",)), (("a b",), ("c",)), (("A",), ("c",)), ((), ("c",)), (("a1",), ("c",))],
)
def test_unusable_lexicons_are_refused(positive, negative):
    with pytest.raises(ValueError):
        Lexicon(positive, negative)


def test_batch_size_has_to_be_positive():
    with pytest.raises(ValueError):
        model_scorer(lexicon_model(WORDS), 0)


def test_missing_library_is_named():
    pytest.importorskip("pyspark")
    try:
        import transformers  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="not installed"):
            transformers_model("some/model")()


def test_throughput_covers_every_batch_size(texts):
    rows = scoring_throughput(texts, lexicon_model(WORDS), "t", (1, 4)).orderBy("batch_size").collect()
    assert [(r.batch_size, r.n_rows) for r in rows] == [(1, len(TEXTS)), (4, len(TEXTS))]
    assert all(r.time_sec > 0 and r.rows_per_sec > 0 for r in rows)


def test_models_agree_on_signs_that_are_no_letters():
    model = lexicon_model(Lexicon(positive=("good",), negative=("the", "and")))()
    scores = {s["label"]: s["score"] for s in model(["the\u00b2 \u00bdand \u2167good"])[0]}
    assert scores == {"NEG": 0.5, "NEU": 0.25, "POS": 0.25}


def letters_model(texts):
    """Scores a text by its letters and refuses one that is too long."""
    assert all(len(text) <= 10 for text in texts)
    return [
        [{"label": "POS", "score": text.count("g") / 10}, {"label": "NEG", "score": text.count("b") / 10}]
        for text in texts
    ]


@pytest.mark.parametrize("text", ["", "gb", "g" * 10, "g" * 10 + "b" * 30, "gg bb gg bb gg", " " * 50, "a " * 40 + "g"])
def test_windows_cover_the_whole_text(text):
    parts = in_windows(text, len, 10)
    assert "".join(part for part, _ in parts) == text
    assert all(n == len(part) <= 10 for part, n in parts)


def test_long_texts_are_scored_whole():
    """By their windows, weighted by length; short ones as the model does."""
    model = windowed(letters_model, len, 10)
    texts = ["ggb", "", "g" * 10 + "b" * 30, "ggb"]
    short, empty, long, again = ({s["label"]: s["score"] for s in scores} for scores in model(texts))
    assert short == again == {"POS": 0.2, "NEG": 0.1} and empty == {"POS": 0, "NEG": 0}
    assert long["POS"] == pytest.approx(0.25) and long["NEG"] == pytest.approx(0.75)


def test_a_hub_model_reads_to_the_end(monkeypatch):
    class Pipe:
        class tokenizer:
            model_max_length = 10**30

            def __new__(cls, text):
                return {"input_ids": [*text]}

        class model:
            class config:
                max_position_embeddings = 10

        def __call__(self, texts):
            return letters_model(texts)

    made = []
    fake = types.ModuleType("transformers")
    fake.pipeline = lambda *args, **kwargs: made.append(kwargs) or Pipe()
    monkeypatch.setitem(sys.modules, "transformers", fake)
    factory = transformers_model("long/texts", 4)
    (scores,) = factory()(["g" * 20 + "b" * 20])
    assert {s["label"]: round(s["score"], 9) for s in scores} == {"POS": 0.5, "NEG": 0.5}
    assert factory() is factory() and len(made) == 1 and "truncation" not in made[0]
