from __future__ import annotations

import itertools
import time
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloakframe.llm import crf_language as crf
from cloakframe.llm.queries import QUERIES
from cloakframe.sources.tables import load_table

EN = "the of and to that is with for was this from have be it on as by at an or".split()
DE = "der die und nicht ein eine das ist mit für von auf zu den dem sich als auch im an".split()


def make(words, n, seed):
    r = np.random.default_rng(seed)
    return [" ".join(r.choice(words, r.integers(5, 30))) + "." for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return crf.fit(make(EN, 40, 1) + make(DE, 40, 2), ["en"] * 40 + ["de"] * 40)


def test_marginals_against_all_paths():
    r = np.random.default_rng(3)
    k, lengths = 3, np.array([4, 3, 1])
    scores, move = r.normal(size=(8, k)).astype(np.float32), r.normal(size=(k, k)).astype(np.float32)
    first = np.array([0, 4, 7])
    got = np.zeros((8, k))
    for at, held, _ in crf.marginals(scores, first, lengths, move):
        got[at] = held
    for f, n in zip(first, lengths, strict=True):
        want = np.zeros((n, k))
        for path in product(range(k), repeat=int(n)):
            weight = np.exp(sum(scores[f + t, y] for t, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            for t, y in enumerate(path):
                want[t, y] += weight
        want /= want.sum(axis=1, keepdims=True)
        assert np.allclose(got[f : f + n], want, atol=1e-4)


def test_words_and_slots():
    words = crf.Words(["Ab c1dé", "", "x", "ab"])
    assert np.diff(words.first).tolist() == [3, 0, 1, 1] and words.lengths.tolist() == [2, 1, 3, 1, 2]
    assert words.whole[0] == words.whole[4] and len(set(words.whole.tolist())) == 4


def test_code_switched_text(model):
    text = " ".join(EN[:10] + DE[:6])
    words = crf.Words([text])
    marks = np.zeros((len(words), 2))
    for at, held, _ in crf.marginals(model.scores(words), words.first[:-1], np.diff(words.first), model.move):
        marks[at] = held
    assert [model.labels[i] for i in marks.argmax(axis=1)] == ["en"] * 10 + ["de"] * 6
    assert np.all(np.diag(model.move) > model.move.mean())
    name, score = crf.label(model, [text])
    assert name == ["en"] and 0.5 < score[0] < 0.75


def test_odd_texts(model):
    texts = [None, "", "123 ... ²", "№ 5", "the " * 20_000, "und", "İ", "漢字", "\x00the\x00"]
    names, scores = crf.label(model, texts)
    assert names[:4] == ["und"] * 4 and scores[:4].tolist() == [0] * 4
    assert names[4] == "en" and names[5] == "de" and all(0 <= s <= 1 for s in scores)
    assert "und" not in names[4:] and crf.label(crf.Model([]), ["the"])[0] == ["und"]


def test_held_out_accuracy(spark, data_dir):
    rows = QUERIES["op2_crf_language"](spark, data_dir).collect()
    docs = {d.doc_id: d for d in load_table(spark, data_dir, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    judged = [r for r in rows if r.held_out and docs[r.doc_id].lang and r.lang_pred != "und"]
    assert len(judged) > 30
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in judged) >= 0.97 * len(judged)


def test_held_out_labels_are_not_learned(spark):
    rows = [(i, t, "en") for i, t in enumerate(make(EN, 60, 4))]
    rows = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else n) for i, t, n in rows]
    got = crf.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.lang_pred for r in got} == {"en"}


def test_odd_rows(spark):
    rows = [(i, t, "en", 0) for i, t in enumerate(make(EN, 30, 5))] + [(100 + i, t, "de", 0) for i, t in enumerate(make(DE, 30, 6))]
    rows += [(None, "der die", "zz", 0), (500, None, "en", 0), (501, "the of", None, 0), (7, "7", "en", 0), (7, "7", "en", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, extra int")
    got = crf.identify(df)
    assert got.count() == len(rows) and got.columns == ["doc_id", "text", "lang", "extra", "held_out", "lang_pred", "score"]
    by = {r.doc_id: r for r in got.collect()}
    assert by[None].lang_pred == "de" and by[None].held_out is False
    assert by[500].lang_pred == "und" and by[501].lang_pred == "en" and by[7].lang_pred == "und"
    with pytest.raises(ValueError, match="hidden"):
        crf.identify(df.withColumn("Score", F.lit(1)))
    kept = crf.keep_identified(df.withColumn("score", F.lit(1)))
    assert kept.columns == [*df.columns, "score"] and kept.count() == len(rows) - 3


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert crf.identify(df).collect() == []
    unlabelled = spark.createDataFrame([(1, "the", None)], df.schema)
    assert [r.lang_pred for r in crf.identify(unlabelled).collect()] == ["und"]
    assert crf.keep_identified(unlabelled).count() == 1


def test_all_labels_are_learned(spark):
    """Forty languages, each with words of its own, the rarest of them only in one text of over 50,000 characters."""
    def words(j):
        r = np.random.default_rng(100 + j)
        letters = list("abcdefghijklmnopqrstuvwxyz")
        return ["".join(r.choice(letters, 5)) for _ in range(12)]

    rows = [(f"l{j:02}", t) for j in range(39) for t in make(words(j), 10 + j, j)]
    book = " ".join(make(words(39), 800, 39))
    assert len(book) > crf.LONGEST
    rows.append(("rare", book))
    df = spark.createDataFrame([(i, t, n) for i, (n, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = crf.learn(df)
    assert len(model.labels) == 40 and model.bits < crf.TABLE
    fresh = [make(words(j), 1, 1000 + j)[0] for j in range(40)]
    assert crf.label(model, fresh)[0] == [*(f"l{j:02}" for j in range(39)), "rare"]


def test_mixed_documents_are_kept(spark):
    """Three languages in equal parts, and a language that was not learned."""
    es = "el la los que del por con para una las se su al lo como mas pero sus le ya".split()
    rows = [(f, t) for f, w in (("en", EN), ("de", DE), ("es", es)) for t in make(w, 40, 7)]
    mixed = " ".join(EN + DE + es)
    df = spark.createDataFrame([(i, t, n) for i, (n, t) in enumerate(rows)] + [(900, mixed, None), (901, "kaj estas tio kio", None), (902, "1 2", None)], "doc_id long, text string, lang string")
    assert {r.doc_id: r.score for r in crf.identify(df).where("doc_id = 900").collect()}[900] < 0.4
    assert {r.doc_id for r in crf.keep_identified(df).collect()} == set(range(120)) | {900, 901}


def some_model(labels="abc", seed=4):
    draws = np.random.default_rng(seed)
    model = crf.Model(list(labels))
    for name in ("pair", "triple", "prefix", "suffix", "lexicon", "move"):
        table = getattr(model, name)
        table[:] = draws.normal(size=table.shape)
    return model


def test_blocks_give_the_same_marginals():
    draws = np.random.default_rng(5)
    for sizes in ([1], [7], [0, 3, 0, 12, 1], [40, 0]):
        n = sum(sizes)
        scores, move = draws.normal(size=(n, 3)).astype(np.float32), draws.normal(size=(3, 3)).astype(np.float32)
        first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        order = np.argsort(-np.array(sizes), kind="stable")
        wanted = np.empty((n, 3))
        lengths = np.array(sizes)[order]
        for at, held, _ in crf.marginals(scores, first[order], lengths, move):
            wanted[at] = held
        for block in (1, 2, 5, 16, 100):
            assert np.allclose(crf.blocked_marginals(scores, first, move, block), wanted, atol=1e-4)


def test_long_and_short_texts_score_alike(monkeypatch):
    model = some_model()
    texts = ["one two three", None, "", "ünd Straße", "a b c " * 50, "123"]
    names, scores = crf.label(model, texts)
    monkeypatch.setattr(crf, "LONG", 0)
    again, blocked = crf.label(model, texts)
    assert names == again and np.allclose(scores, blocked, atol=1e-4)


def test_a_very_long_text_ends_soon():
    begun = time.perf_counter()
    names, scores = crf.label(some_model("ab"), ["the quick brown fox " * 1_000_000])
    assert names[0] in "ab" and time.perf_counter() - begun < 60


def test_document_against_brute_force():
    """Features, lexicon and label of a document recomputed word by word, over all paths."""
    model, text = some_model("ab"), "Ein word, été"
    words = [w.encode() for w in ("ein", "word", "été")]
    slot = crf.Words._slot
    dummy = crf.Words([""], model.bits)

    def scores(word):
        c = [32, *word, 32]
        total = model.prefix[slot(dummy, np.array([word[0] << 16 | (word[1] if len(word) > 1 else 0) << 8 | (word[2] if len(word) > 2 else 0)]), 2)[0]].astype(float)
        n = len(word)
        total = total + model.suffix[slot(dummy, np.array([word[-1] << 16 | (word[-2] if n > 1 else 0) << 8 | (word[-3] if n > 2 else 0)]), 3)[0]]
        for i in range(1, n + 1):
            total = total + model.pair[c[i - 1] << 8 | c[i]] + model.triple[slot(dummy, np.array([c[i - 1] << 16 | c[i] << 8 | c[i + 1]]), 1)[0]]
        alone = crf.Words([word.decode()], model.bits)
        return total + model.lexicon[alone.whole[0]] * model.trust

    local = [scores(w) for w in words]
    weights = {}
    for path in itertools.product(range(2), repeat=3):
        weights[path] = np.exp(sum(local[i][y] for i, y in enumerate(path)) + sum(model.move[a, b] for a, b in itertools.pairwise(path)))
    total = sum(weights.values())
    marginal = [[sum(w for p, w in weights.items() if p[i] == y) / total for y in range(2)] for i in range(3)]
    names, found = crf.label(model, [text])
    means = np.mean(marginal, axis=0)
    assert names == [model.labels[int(means.argmax())]] and abs(found[0] - means.max()) < 1e-3
    labels = crf.word_labels(model, text)
    assert [text[a:b] for a, b, _, _ in labels] == ["Ein", "word", "été"]
    assert all(abs(p - max(m)) < 1e-3 and name == model.labels[int(np.argmax(m))] for (_, _, name, p), m in zip(labels, marginal, strict=True))


def test_words_of_code_switched_texts(spark):
    english = "the house and the garden with many people in the old town "
    german = "das haus und der garten mit vielen leuten in der alten stadt "
    rows = [(i, (english if i % 2 else german) * 3, "en" if i % 2 else "de") for i in range(40)]
    model = crf.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = f"{english}{german}"
    docs = spark.createDataFrame([(1, mixed), (2, None), (3, "İ x 1"), (4, "")], "doc_id long, text string")
    got = crf.label_words(docs, model).orderBy("doc_id", "start").collect()
    ours = [r for r in got if r.doc_id == 1]
    assert [r.word for r in ours] == mixed.split() and all(mixed[r.start : r.end] == r.word for r in ours)
    right = sum(r.lang == ("en" if r.start < len(english) else "de") for r in ours)
    assert right >= 0.9 * len(ours) and all(0 < r.probability <= 1 for r in ours)
    assert {r.word for r in got if r.doc_id == 3} == {"İ", "x"} and {r.doc_id for r in got} == {1, 3}
