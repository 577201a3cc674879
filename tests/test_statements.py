from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from cloakframe.functions import statements as st
from cloakframe.operators import workload as w


def lexer(text: str) -> str:
    """The shape by hand, one character at a time."""
    out, i, n = [], 0, len(text)
    while i < n:
        c = text[i]
        if c.isspace():
            i += 1
        elif c == "'" or c in "nN" and text[i + 1 : i + 2] == "'":
            i += 1 + (c != "'")
            while i < n and (text[i] != "'" or text[i + 1 : i + 2] == "'"):
                i += 2 if text[i] == "'" else 1
            i += 1
            out.append("?")
        elif text.startswith("--", i):
            while i < n and text[i] not in "\r\n":
                i += 1
        elif text.startswith("/*", i):
            depth, i = 1, i + 2
            while i < n and depth:
                if text.startswith("/*", i) or text.startswith("*/", i):
                    depth += 1 if text[i] == "/" else -1
                    i += 2
                else:
                    i += 1
        elif c in '"[':
            close, start = {'"': '"', "[": "]"}[c], i
            i += 1
            while i < n and (text[i] != close or text[i + 1 : i + 2] == close):
                i += 2 if text[i] == close else 1
            i += 1
            out.append(text[start:i])
        elif c.isalpha() or c in "_@#$":
            start = i
            while i < n and (text[i].isalnum() or text[i] in "_@#$"):
                i += 1
            out.append(text[start:i].lower())
        elif c.isdigit() or c == "." and text[i + 1 : i + 2].isdigit():
            if text[i : i + 2].lower() == "0x":
                i += 2
                while i < n and text[i] in "0123456789abcdefABCDEF":
                    i += 1
            else:
                dots = 0
                while i < n and (text[i].isdigit() or text[i] == "." and not dots):
                    dots += text[i] == "."
                    i += 1
                j = i + 1 + (text[i + 1 : i + 2] in ("+", "-"))
                if text[i : i + 1] in ("e", "E") and text[j : j + 1].isdigit():
                    i = j
                    while i < n and text[i].isdigit():
                        i += 1
            out.append("?")
        else:
            out.append(c)
            i += 1
    shaped, k = [], 0
    while k < len(out):
        shaped.append(out[k])
        if out[k] == "in" and out[k + 1 : k + 2] == ["("]:
            j = k + 2
            while True:
                j += out[j : j + 1] in (["+"], ["-"])
                if out[j : j + 1] != ["?"]:
                    break
                j += 1
                if out[j : j + 1] == [")"]:
                    shaped += ["(", "?", ")"]
                    k = j
                    break
                if out[j : j + 1] != [","]:
                    break
                j += 1
        k += 1
    return " ".join(shaped)


def shapes(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    found = rows.select("i", st.statement_shape(F.col("t")).alias("s"), st.statement_hash(F.col("t")).alias("h")).collect()
    return [(r.s, r.h) for r in sorted(found)]


def test_against_a_lexer_by_hand(spark):
    chance = random.Random(1)
    pieces = ["'", "''", '"', "[", "]", "/*", "*/", "--", "\n", " ", "\t", "a", "IN", "in", "(", ")", ",", "?", "1", "2.5", "1e-3", ".5", "0xFf", "N'", "x1", "é", "-", "+",
              "'it''s'", "/* 'q' */", "in (1, 2)", ";", "*", "e"]
    texts = ["".join(chance.choices(pieces, k=chance.randint(0, 16))) for _ in range(6000)]
    for text, (shape, _) in zip(texts, shapes(spark, texts), strict=True):
        assert shape == lexer(text), text


def test_one_statement_many_runs(spark):
    same = [
        "SELECT a FROM t WHERE k = 1 AND n = 'x' AND j IN (1,2,3)", "select a\n\tfrom T where K=27 and N = 'it''s -- no comment' and J in ( -4 )",
        "SELECT a -- it's a comment\nFROM t /* one /* nested ' */ still */ WHERE k = 0x1F AND n=N'/* no */' AND j IN ('a', 'b') ",
    ]
    other = ["SELECT b FROM t WHERE k = 1 AND n = 'x' AND j IN (1,2,3)", 'SELECT "a" FROM t WHERE k = 1 AND n = \'x\' AND j IN (1)', "SELECT a FROM t WHERE k = 1"]
    found = shapes(spark, same + other)
    assert len({h for _, h in found[:3]}) == 1 and len({h for _, h in found}) == 4
    assert found[0][0] == "select a from t where k = ? and n = ? and j in ( ? )"


def test_odd_texts(spark):
    found = shapes(spark, [None, "", "  ", "-- only", "/* open", "'open", "in", "in (1, x)", "begin (1, 2)"])
    assert found[0] == (None, None)
    assert [s for s, _ in found[1:]] == ["", "", "", "", "?", "in", "in ( ? , x )", "begin ( ? , ? )"]


def test_long_texts_take_linear_time(spark):
    begun = time.perf_counter()
    texts = [p * (400_000 // len(p)) for p in ("'a''", "/* ", "-", "(1,", "in (1,2) ", "[x", "a ", "'", "/*/", '"')]
    assert len(shapes(spark, texts)) == len(texts) and time.perf_counter() - begun < 60


def test_statements_of_a_log(spark):
    rows = [(f"SELECT x FROM t WHERE k = {i}", 2_000_000, i) for i in range(5)] + [("SELECT y FROM t", 3_000_000, 9)]
    log = spark.createDataFrame(rows, "query_text string, elapsed_us long, n int").select(
        "query_text", "elapsed_us", F.lit(1).cast("long").alias("cpu_us"), F.lit(1).cast("long").alias("logical_reads"),
        F.lit(1).cast("long").alias("physical_reads"), F.timestamp_seconds("n").alias("executed_at"),
    )
    slow = w.slow_groups(w.with_statement_hash(log)).collect()
    assert [(r.query_text, r.execution_count) for r in slow] == [("SELECT y FROM t", 1), ("SELECT x FROM t WHERE k = 4", 5)]
    assert w.slow_groups(w.with_statement_hash(log), unhashed=log).collect() == slow


def test_shapes_are_taken_once(spark, tmp_path):
    """Of the whole log shapes are taken by one scan; the lookup takes them below the filter by time."""
    ones = [f"1L AS {c}" for c in ("cpu_us", "logical_reads", "physical_reads")]
    text = "concat('SELECT ', id % 7, ' FROM t', id % 5) AS query_text"
    spark.range(100).selectExpr(text, "id * 1000000 AS elapsed_us", *ones, "timestamp_seconds(id) AS executed_at").write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    slow = w.slow_groups(w.with_statement_hash(log), unhashed=log)
    assert len(slow.collect()) == 5
    final = slow._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final
    scans = final.split("regexp_extract_all(")[1:]
    assert len(scans) == 2 and "LeftSemi" in scans[-1] + scans[0]


def test_against_the_pattern_of_tokens(spark):
    """Runs of words and signs, set apart afterwards, give what one token after another gives: deep comments, marks beside
    letters, letters whose lower case depends on their neighbours."""
    token = rf"{st.STRING}|{st.COMMENT}|{st.NAME}|{st.WORD}|{st.NUMBER}|[^\s]"

    def placed(t):
        kept = F.when(t.rlike(r'^["\[]'), t).otherwise(F.lower(t))
        return F.when(t.rlike(r"^(?:--|/\*)"), F.lit(None)).when(t.rlike(r"^(?:[nN]?'|[0-9]|\.[0-9])"), F.lit("?")).otherwise(kept)

    chance = random.Random(2)
    pieces = ["/*" * 9, "/*" * 7, "*/" * 8, "/", "*", "-", "--", "'", '"', "[", "]", "\u0130", "\u0391\u03a3", "\u0307", "\u00b2", "\u0663", "N'", "n", ".", "1", ".5", "1e",
              "\u00a0", "\x0b", " ", "\n", "$1", "\\", "\U0001d49c", "in (1,-2)", "a"]
    rows = [("".join(chance.choices(pieces, k=chance.randint(0, 20))),) for _ in range(5000)]
    tokens = F.filter(F.transform(F.regexp_extract_all("t", F.lit(token), F.lit(0)), placed), lambda t: t.isNotNull())
    old = F.regexp_replace(F.array_join(tokens, " "), st.IN_LIST, "in ( ? )")
    assert spark.createDataFrame(rows, "t string").repartition(4).where(old != st.statement_shape(F.col("t"))).collect() == []
