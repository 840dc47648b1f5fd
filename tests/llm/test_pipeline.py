"""The pipeline's stages one by one on planted rows, and as a whole."""

from __future__ import annotations

import random

import corpus_pipeline
from feedmart.llm.quality_rules import RULES, Page

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


def planted(spark, folder):
    rng = random.Random(11)

    def prose(n=90):
        return " ".join("".join(rng.choices("aeioulmnrst", k=rng.choice([2, 4, 6]))) for _ in range(n))

    item = prose(25)
    docs = [(k, prose(), "en", f"s{k % 3}", 1) for k in range(60)]
    docs += [(100, docs[3][1], "en", "s0", 1), (101, docs[3][1] + " end", "en", "s1", 1), (3, docs[3][1], "en", "s0", 1)]
    docs += [(200, f"{prose(50)} you idiot {prose(50)}", "en", "s0", 1), (201, prose(10), "en", "s0", 1)]
    docs += [(202, " ".join(w + "%%%" for w in prose().split()), "en", "s1", 1), (203, f"{prose()} {item} {prose()}", "en", "s2", 1)]
    docs += [(204, None, None, None, None), (205, "", "en", "s0", 0), (None, prose(), "en", None, 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, prose(30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    rows = planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == COLUMNS
        kept[name] = sorted((r["doc_id"] for r in out.collect()), key=repr)
    every = sorted((r[0] for r in rows), key=repr)

    def without(*ids):
        return [i for i in every if i not in ids]

    assert kept["toxicity"] == without(200)
    assert kept["quality rules"] == sorted((r[0] for r in rows if not any(rule(Page(r[1])) for rule in RULES.values())), key=repr)
    assert kept["near duplicates"] == sorted({*every} - {100, 101, 205}, key=repr) or 101 in kept["near duplicates"]
    assert kept["near duplicates"].count(3) == 1 and 100 not in kept["near duplicates"] and 205 not in kept["near duplicates"]
    assert kept["decontamination"] == without(203)


def test_rows_without_an_id_or_with_one_id_are_told_apart(spark, tmp_path):
    folder = str(tmp_path)
    rows = planted(spark, folder)
    item = spark.read.parquet(f"{folder}/benchmark.parquet").filter("item_id = 1").first()["text"]
    rng = random.Random(12)

    def prose(n=90):
        return " ".join("".join(rng.choices("aeioulmnrst", k=rng.choice([2, 4, 6]))) for _ in range(n))

    clean = [prose() for _ in range(6)]
    more = [(None, clean[0]), (None, clean[1]), (None, clean[1]), (700, clean[2]), (700, clean[3]), (701, clean[4]), (701, clean[4])]
    more += [(None, f"{clean[5]} {item}"), (700, f"{prose()} {item}"), (None, None), (None, rows[3][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in more], "doc_id long, text string, lang string, source string, n_chars long")
    near = STAGES["near duplicates"](spark, docs, folder).collect()
    assert sorted(str(r["text"]) for r in near) == sorted({str(t) for _, t in more})
    kept = STAGES["decontamination"](spark, docs, folder).collect()
    assert sorted(str(r["text"]) for r in kept) == sorted(str(t) for _, t in more if item not in (t or ""))


def test_whole(spark, tmp_path):
    folder = str(tmp_path)
    planted(spark, folder)
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()]
    assert not {100, 200, 201, 202, 203, 204, 205} & set(got)
    assert len(got) == len(set(got)) and len(got) > 20


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path)
    planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
