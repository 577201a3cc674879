from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cloakframe.llm import spelling as sp


def edits(word: str, letters: str) -> set[str]:
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    return out - {word}


def dictionary(words, shortest, longest, above):
    counts = Counter()
    for w in words:
        t = sp.padded(w, longest)
        counts.update(t[i : i + q] for q in range(shortest, longest + 1) for i in range(len(t) - q + 1))
    return {g: n for g, n in counts.items() if n > above}


@pytest.mark.parametrize(("shortest", "longest", "letters"), [(3, 5, "abc"), (2, 4, "ab"), (4, 6, "abcdefgh"), (3, 3, "ab")])
def test_every_near_word_is_listed_beside(shortest, longest, letters):
    """Near words meet in a gram among those that the bound leaves: for all edits of random words."""
    chance = random.Random(longest)
    words = ["".join(chance.choices(letters, k=chance.randint(7, 14))) for _ in range(60)]
    edge = longest - 1
    for above in (0, 2, 8, 10**9):
        frequent = dictionary(words, shortest, longest, above)

        def grams(word, frequent=frequent):
            text = sp.padded(word, longest)
            return text, sp.decompose(text, frequent, shortest, longest)

        for w in words[:20]:
            text, spans = grams(w)
            (_, end), (start, _) = pair = sp.asked_pair(text, spans, frequent, longest)
            assert sp.affected_bound(list(pair), len(w), longest) == 1
            for other in edits(w, letters):
                if len(other) >= len(w):
                    theirs, listed = grams(other)
                    in_front = theirs[:end] == text[:end] and end in {b for _, b in listed}
                    moved = start + len(other) - len(w)
                    behind = theirs[moved:] == text[start:] and moved in {a for a, _ in listed}
                    assert in_front or behind, (w, other, above)
                    assert 0 < end - edge < len(other) and 0 < moved - edge < len(other)


def test_bound_holds_for_each_edit():
    """No edit takes more grams from a word than its bound says."""
    chance = random.Random(3)
    words = ["".join(chance.choices("abcd", k=chance.randint(7, 12))) for _ in range(80)]
    frequent = dictionary(words, 3, 5, 3)
    for w in words:
        spans = sp.decompose(sp.padded(w), frequent)
        bound = sp.affected_bound(spans, len(w))
        text = sp.padded(w)
        for other in edits(w, "abcd"):
            theirs, shift = sp.padded(other), len(other) - len(w)
            held = {(theirs[a:b], a) for a, b in sp.decompose(theirs, frequent)}
            kept = sum((text[a:b], a) in held or (text[a:b], a + shift) in held for a, b in spans)
            assert len(spans) - kept <= bound


def test_lists_are_short():
    """A gram that could still grow is in at most as many words as the threshold says."""
    chance = random.Random(4)
    words = sorted({"".join(chance.choices("abcdefghij", k=9)) for _ in range(3000)})
    frequent = dictionary(words, 3, 5, 16)
    lists = Counter(sp.padded(w)[a:b] for w in words for a, b in sp.decompose(sp.padded(w), frequent) if b - a < 5)
    assert lists and max(lists.values()) <= 16


def brute(counts: dict[str, int], ratio: int = 10) -> list[tuple]:
    letters = "".join(sorted({c for w in counts for c in w}))
    rows, form = [], {}
    near = {w: edits(w, letters) & counts.keys() for w in counts}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(rows)


def test_against_brute_force(spark):
    chance = random.Random(5)
    counts = {"".join(chance.choices("abé", k=chance.randint(7, 9))): chance.choice([2, 3, 40, 500, 6000]) for _ in range(1500)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    for grams in ({}, {"shortest": 2, "longest": 4, "least": 2}, {"least": 100000}, {"least": 1, "most_grams": 50}):
        got = sp.spelling_variants(words, **grams)
        assert sorted(map(tuple, got.collect())) == brute(counts)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_words_and_noise(spark):
    import zlib

    texts = ["Straßenbahn strassenbahn STRASSENBAHN short ÄPFELMUS äpfelmus äpfelmus", "x×x÷xxxx ABCDEFGhijk abcdefghijk_abcdefg"]
    docs = spark.createDataFrame([(i, t) for i in range(50) for t in texts], "doc_id long, text string")
    wanted = Counter()
    for i in range(50):
        for t in texts:
            for run in "".join(c if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" else " " for c in t).split(" "):
                run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{i}:{run}".encode())
                if run and h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                wanted[run] += len(run) >= 7
    got = sp.vocabulary(docs, drop_one_in=31).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in wanted.items() if n >= 2}
    assert any("Ä" in r.word for r in got)


def test_odd_rows(spark):
    long = "ab" * 60_000
    docs = spark.createDataFrame(
        [(None, "wordword wordword"), (1, None), (2, ""), (3, long), (3, long), (4, long + "c"), (5, long + "c"), (6, "unseenword")],
        "doc_id long, text string",
    ).withColumn("word", F.lit("clash")).withColumn("n", F.lit(0))
    got = {r.word: r for r in sp.spelling_variants(sp.vocabulary(docs)).collect()}
    assert got.keys() == {"wordword", long, long + "c"}
    assert got[long].n_near == 1 and got["wordword"].n_near == 0
    assert sp.spelling_variants(sp.vocabulary(docs.limit(0))).collect() == []


def test_words_that_are_too_short_are_refused(spark):
    words = spark.createDataFrame([("abcde", 3)], "word string, n long")
    with pytest.raises(PySparkException):
        sp.near_pairs(words).collect()
    with pytest.raises(ValueError):
        sp.near_pairs(words, shortest=1)


def test_long_words_against_brute_force(spark):
    """Around and beyond the length from which on the middle decides."""
    chance = random.Random(8)
    counts = {}
    for size in (62, 63, 64, 65, 66, 90):
        for _ in range(4):
            word = "".join(chance.choices("ab", k=size))
            counts |= {word: 50, **{w: 3 for w in chance.sample(sorted(edits(word, "ab")), 40)}}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    for grams in ({}, {"least": 1}):
        assert sorted(map(tuple, sp.spelling_variants(words, **grams).collect())) == brute(counts)


def test_one_edit_of_long_words(spark):
    base = "abcé" * 30
    others = {base[:7] + "x" + base[8:]: True, base + "x": True, "x" + base: True, base[:50] + "é" + base[50:]: True, base: False,
              "x" + base[1:-1] + "x": False, base[1:] + "x": False, "xx" + base[1:]: False}
    rows = [(base, b, wanted) for b, wanted in others.items() if len(b) >= len(base)]
    got = spark.createDataFrame(rows, "a string, b string, wanted boolean").withColumn("got", sp.one_edit(F.col("a"), F.col("b"))).collect()
    assert [r.got for r in got] == [r.wanted for r in got]
