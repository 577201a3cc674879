"""The pipeline against brute force: SQL for the rules and the benchmark, plain Python for the rest."""

from __future__ import annotations

import random
import re
import shutil
import textwrap
from collections import defaultdict

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from cloakframe.llm import crf_language as crf
from cloakframe.llm.oracle import SQL
from cloakframe.sources.tables import load_table
from test_packing import check_bins
from test_simhash import plain, roots


def chosen(sql: str, verdict: str, docs: dict, data_dir: str) -> set[int]:
    con = duckdb.connect()
    rows = [{"doc_id": i, "text": d.text} for i, d in docs.items()]
    con.register("documents", pa.Table.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("text", pa.string())])))
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{data_dir}/benchmark.parquet'")
    return {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql}) WHERE {verdict}").fetchall()}


def sentences(name: str, words: int, per_line: int = 10) -> str:
    """So many different words, in sentences on lines of their own."""
    listed = [f"{name}{i}" for i in range(words)]
    return "\n".join(" ".join(listed[i : i + per_line]) + "." for i in range(0, words, per_line))


def apart(base: str, bits: int, but: list[str], name: str) -> str:
    """A variant of a text whose fingerprint differs in so many bits, and from those of others in more than three."""
    chance, words = random.Random(name), base.split(" ")
    for _ in range(20_000):
        some = list(words)
        for _ in range(chance.randint(1, 12)):
            some[chance.randrange(len(some) - 1)] = f"{name}{chance.randrange(10**6)}"
        found = plain(" ".join(some))
        if (found ^ plain(base)).bit_count() == bits and all((found ^ plain(t)).bit_count() > 3 for t in but):
            return " ".join(some)
    raise AssertionError


def edge_documents(passage: list[str]) -> tuple[dict[int, str], set[int]]:
    """Documents on both sides of every threshold, and those that a run keeps."""
    prose = " ".join(sentences("wrap", 200).split("\n"))
    base = " ".join(f"base{i}" for i in range(400))
    three = apart(base, 3, [], "three")
    texts = {
        1: sentences("few", 50), 2: sentences("less", 49),  # words
        3: textwrap.fill(prose, 72), 4: "\n".join(f"{s}x" for s in sentences("open", 200).split(".")),  # ends of sentences
        7: sentences("eins", 60) + "\n" + sentences("the of and", 60) + "\n" + sentences("les des que", 60),  # languages
        8: " ".join(str(1000 + i) for i in range(80)),
        9: base, 10: three, 11: apart(base, 4, [three], "four"),  # fingerprints
        12: sentences("dirty", 247) + "\n" + " ".join(passage) + ".", 13: sentences("clean", 248) + "\n" + " ".join(passage) + ".",
    }
    # A line of text that goes, of exactly two fifths of all characters, and of one more.
    kept_line = sentences("stay", 60, 60)
    kept_line += "." * (len(kept_line) % 3 and 3 - len(kept_line) % 3)
    lost = len(kept_line) * 2 // 3
    texts[5] = "z" * lost + "\n\n" + kept_line
    texts[6] = "y" * (lost + 1) + "\n\n" + kept_line.replace("stay", "gone")
    return {i + 10**9: t for i, t in texts.items()}, {i + 10**9 for i in (1, 3, 5, 7, 9, 11, 13)}


def test_run(spark, data_dir, tmp_path):
    given = load_table(spark, data_dir, "documents")
    item = load_table(spark, data_dir, "benchmark").orderBy("item_id").first()
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", item.text.lower()) if w]
    assert len(words) >= 13
    extra, stays = edge_documents(words[:13])
    rows = [(i, t, "en", "edge", len(t)) for i, t in extra.items()]
    given.unionByName(spark.createDataFrame(rows, given.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    shutil.copy(f"{data_dir}/benchmark.parquet", f"{tmp_path}/benchmark.parquet")
    data_dir = str(tmp_path)

    table = load_table(spark, data_dir, "documents")
    docs = {d.doc_id: d for d in table.collect()}
    left = chosen(SQL["op8_quality_rules"], "kept", docs, data_dir)
    docs = {i: d for i, d in docs.items() if i in left}
    assert {i - 10**9 for i in docs if i >= 10**9} == {1, 3, 5, 7, 8, 9, 10, 11, 12, 13}

    learned = spark.createDataFrame(list(docs.values()), table.schema).where(~crf.held_out(F.col("doc_id")))
    names, _ = crf.label(crf.learn(learned), [d.text for d in docs.values()])
    docs = {i: d for (i, d), n in zip(docs.items(), names, strict=True) if n != "und"}
    assert 10**9 + 8 not in docs and 10**9 + 7 in docs

    root = roots({i: plain(d.text) for i, d in docs.items()})
    docs = {i: d for i, d in docs.items() if root[i] == i}
    assert 10**9 + 10 not in docs and 10**9 + 11 in docs

    bad = chosen(SQL["op1_decontaminate"], "contaminated", docs, data_dir)
    docs = {i: d for i, d in docs.items() if i not in bad}
    assert {i for i in docs if i >= 10**9} == stays

    rows = corpus_pipeline.run(spark, data_dir).collect()
    lengths = defaultdict(int)
    for r in rows:
        lengths[r.doc_id] += r.n_tokens
    assert lengths == {i: len(d.text.encode().split()) + 1 for i, d in docs.items()}
    check_bins(rows, (512, 1024, 2048, 4096, 8192))


def test_stages_keep_the_columns(spark, data_dir):
    docs = load_table(spark, data_dir, "documents").limit(40).withColumnRenamed("n_chars", "Score")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "language_id", "simhash_near_dedup", "decontamination", "best_fit_packing"
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, data_dir).schema == docs.schema


def test_empty_table(spark, data_dir):
    docs = load_table(spark, data_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, data_dir).collect() == []
