from __future__ import annotations

import random
import re
import textwrap

import pytest

from cloakframe.llm import quality_rules as rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
GOOD = "It was a fine day and they went out to see the old town by the sea. "


def brute(text, w=None):
    w = WORDS.findall(text or "")
    at: dict = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    return len({i + k for p in at.values() if len(p) > 1 for i in p for k in range(3)})


def judge(spark, texts, **more):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kept int")
    return sorted(rules.quality_rules(df, **more).collect(), key=lambda r: r.doc_id)


def test_repeated_words(spark):
    random.seed(6)
    texts = [" ".join(random.choices("abc", k=random.randint(0, 40))) for _ in range(150)]
    texts += [None, "", "a", "a b", "a b c", "a a a", "a a a a", "a b c " * 3000, "x y z q x y z", " ".join(map(str, range(20_000)))]
    for r, t in zip(judge(spark, texts), texts, strict=True):
        assert r.n_repeat_words == brute(t), t


@pytest.mark.parametrize(
    "line,fails",
    [
        ("Home | News | Sport | Weather", True), ("a### b*** c%%% d$$$.", True), ("All rights reserved.", True),
        ("no end of a sentence here", True), ("“A sentence.”", False), ("Home | News.", False), ("", False), ("  \t", False),
        ("All rights reserved, " + GOOD * 6, False), ("x = 3", True), ("Ende? ja", False),
    ],
)
def test_lines(spark, line, fails):
    r = judge(spark, [GOOD + "\n" + line])[0]
    assert r.n_failed_lines == int(fails)
    assert r.cleaned == (GOOD if fails else GOOD + "\n" + line)


def test_verdict(spark):
    body = "\n".join(" ".join(f"{w}{i}" for w in GOOD.split()) + "." for i in range(6))
    menu = "\n".join(f"H{i} | N{i} | S{i} | W{i} | X{i}" for i in range(40))
    got = judge(spark, [body, body + "\nHome | a | b | c", menu + "\n" + body, None, "", "word " * 60, "one line of words " + " ".join(map(str, range(60)))])
    assert [r.kept for r in got] == [True, True, False, False, False, False, True]
    assert [r.base_failed for r in got] == [False, False, False, True, True, True, False]
    assert got[3].cleaned is None and got[3].n_words == 0


def test_repeated_lines_and_counts(spark):
    r = judge(spark, ["a b.\n\na b.\na b.\n   # $\n"])[0]
    assert (r.n_dup_lines, r.n_lines, r.n_symbols, r.n_words, r.word_chars) == (2, 4, 2, 8, 13)


def test_keep(spark):
    df = spark.createDataFrame([(1, GOOD + " ".join(map(str, range(50))), "x"), (1, "no", "y"), (None, None, None)], "doc_id long, text string, cleaned string")
    kept = rules.keep_clean(df)
    assert kept.columns == df.columns and [r.cleaned for r in kept.collect()] == ["x"]
    assert rules.keep_clean(df.limit(0)).collect() == []


def test_wrapped_and_other_scripts_are_kept(spark):
    prose = lambda start: " ".join(" ".join(f"{w}{i}" for w in GOOD[:-2].split()) + "." for i in range(start, start + 20))
    paragraphs = "\n\n".join([prose(0), prose(20)])
    wrapped = ["\n".join(textwrap.fill(p, width) for p in paragraphs.split("\n\n")) for width in (40, 60, 72, 80)]
    other = ["\n".join(f"{i} " + line * 3 + end for i in range(12)) for line, end in (
        ("यह एक अच्छा दिन था और वे ", "गए।"), ("یہ ایک اچھا دن تھا اور وہ ", "گئے۔"), ("هل كان يوما جميلا في ", "المدينة؟"),
        ("วันนี้ เป็น วันที่ ดี มาก ", "ครับ"), ("今天 是 很好 的 一天 ", "他说。他走了"),
    )]
    assert [r.n_failed_lines for r in judge(spark, wrapped + other)] == [0] * 9
    assert all(r.kept for r in judge(spark, [*wrapped, paragraphs]))


def test_paragraphs_without_an_end_fail(spark):
    text = "Home\nAbout us\n\n" + GOOD + "\nit goes\non here.\nContact\nImprint\n \nMore"
    assert judge(spark, [text])[0].cleaned == "\n" + GOOD + "\nit goes\non here.\n "
    long = judge(spark, ["no end of it\n" * 100_000])[0]
    assert long.n_failed_lines == 100_000


def test_a_menu_above_a_sentence_fails(spark):
    menu = [f"{word} {i}" for i in range(10) for word in ("Home", "News", "Über uns", "Contact")]
    got = judge(spark, ["\n".join([*menu, GOOD]), "\n".join([GOOD, *menu[:5], "and it goes on."])])
    assert [r.n_failed_lines for r in got] == [40, 4]  # the line before one in lower case goes on
    assert got[0].cleaned == GOOD


def test_what_goes_on(spark):
    long, short = "A line of prose without an end of any kind", "Short one"
    texts = [f"{long}\n{long}\nThe end.", f"{short}\n{short}\nThe end.", f"{short}\nthe end.", f"{long}\n\nThe end.", f"{long}\n(the end.", f"{long}\nno end"]
    assert [r.n_failed_lines for r in judge(spark, texts)] == [0, 2, 0, 1, 0, 2]


def test_phrases_are_no_patterns(spark):
    text = "one (c) two.\nOne c two.\n" + GOOD
    assert judge(spark, [text], boilerplate=("(c)",))[0].n_failed_lines == 1


def test_registered_query_keeps_wrapped_prose(spark, tmp_path):
    from cloakframe.llm.queries import QUERIES

    prose = " ".join(" ".join(f"{w}{i}" for w in GOOD[:-2].split()) + "." for i in range(20))
    hindi = "\n".join(f"{i} " + "यह एक अच्छा दिन था और वे " * 3 + f"गए{i}।" for i in range(12))
    rows = [(1, textwrap.fill(prose, 72)), (2, hindi), (3, "\n".join(["Menu entry"] * 60 + [GOOD]))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, str(tmp_path)).collect()}
    assert got[1].kept and got[1].n_failed_lines == got[2].n_failed_lines == 0 and got[3].n_failed_lines == 60
