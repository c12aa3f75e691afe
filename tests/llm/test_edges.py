"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for each operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldlens.llm import ann, decontaminate, language, license_scan, near_dedup, packing, quality, sharding, toxicity, url_rules
from fieldlens.llm._common import literal_rows

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
LONG = " ".join(WORDS[i * i % 20] for i in range(60_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "s0", 1, "x"), (1, "the quick brown fox jumps over the lazy dog again and again", "en", "s0", 1, "x"), (2, None, None, None, None, None),
    (3, "", "en", "s1", 0, ""), (None, "no id here at all", "en", None, 3, "y"), (4, LONG, "de", "s0", 9, "z"), (5, "\n\t ", None, "s1", 3, "q"), (6, "Héllo wörld ☃ 😀 ÄÖÜ", "fr", "s2", 5, "w"), (7, "one", "en", "s2", 3, "v"),
]
#: Extra columns with names that operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"
CLASHING = ["shard", "slot", "bucket", "k", "row", "label", "kept", "predicted", "words", "line", "spaced"]


@pytest.fixture(scope="module")
def docs(frame):
    df = frame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit(0) for c in CLASHING})


@pytest.fixture(scope="module")
def none(frame):
    return frame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(frame):
    return frame([(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (6, 1, 0), (7, 0, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")


def test_sharding(docs, none):
    rows = sharding.shard_documents(docs, shards=4).collect()
    assert len(rows) == len(ROWS)
    counts = [sum(r["shard"] == s for r in rows) for s in range(4)]
    assert max(counts) - min(counts) <= 1
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (2, 3)} == {(1, 0)}
    assert sharding.shard_documents(none).count() == 0


def test_near_dedup(docs, none):
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_shingles"] == by[3]["n_shingles"] == by[5]["n_shingles"] == 0 and by[7]["n_shingles"] == 1
    assert by[1]["component_id"] == 1 and by[None]["component_id"] is None and by[None]["kept"]
    assert near_dedup.near_duplicates(none).count() == 0
    kept = near_dedup.keep_one(docs)
    assert kept.count() == len(ROWS) - 1 and set(CLASHING) <= set(kept.columns)


def test_packing(docs, none):
    rows = packing.pack_documents(docs).collect()
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total[2] == total[3] == 1 and set(total) == {1, 2, 3, 4, 5, 6, 7, None}
    assert packing.pack_documents(none).count() == 0


def test_classifiers(docs, none, labels, frame):
    for scored in (quality.score_quality(docs, labels), toxicity.score_toxicity(docs, labels)):
        rows = scored.collect()
        assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
    unlabelled = frame([], "doc_id long, quality int, toxic int")
    assert quality.score_quality(docs, unlabelled).count() == len(ROWS) and toxicity.score_toxicity(docs, unlabelled).agg(F.max("score")).first()[0] < 1e-9
    assert quality.score_quality(none, labels).count() == 0 and toxicity.score_toxicity(none, labels).count() == 0


def test_language(docs, none):
    samples = language.training_samples(docs)
    rows = {r["doc_id"]: r for r in language.identify_language(docs, samples).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (2, 3, 5)) and rows[4]["lang_pred"] == "de"
    assert {r["lang_pred"] for r in language.identify_language(docs, {}).collect()} == {"und"}
    assert language.identify_language(none, samples).count() == 0 and language.training_samples(none) == {}


def test_decontamination(docs, none, frame):
    bench = frame([(1, "Quick, brown FOX jumps over the lazy dog"), (2, None), (3, "..."), (4, "one"), (5, "on")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert found == {(1, 1, 0), (7, 4, 0)}
    assert decontaminate.find_leaks(none, bench).count() == 0 and decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaking(docs, bench).count() == len(ROWS) - 3


def test_license_scan(docs, none, frame):
    rows = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    assert rows[2]["n_words"] == 0 and rows[2]["labels"] == "" and rows[2]["first_word"] is None
    more = frame([(1, "CC-BY cc by, Cc By all rights reserved", *[None] * 4)], SCHEMA)
    row = license_scan.scan_licenses(more).first()
    assert (row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == (4, 0, 6, "cc-by,reserved")
    wrapped = frame(
        [
            (1, " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that", *[None] * 4),
            (2, "word " * 700 + "This Source Code Form is subject to the terms of the\nMozilla Public\nLicense, v. 2.0. " + "word " * 300, *[None] * 4),
            (3, "released " + "word " * 100 + "under the MIT License", *[None] * 4),
        ],
        SCHEMA,
    )
    assert {r["doc_id"]: r["labels"] for r in license_scan.scan_licenses(wrapped).collect()} == {1: "bsd", 2: "mpl-2.0", 3: ""}
    assert license_scan.scan_licenses(none).count() == 0 and license_scan.scan_licenses(docs, templates=[]).count() == len(ROWS)


def test_url_rules(spark, frame):
    pages = frame([(1, "http://A.example.NET/en/x?q"), (1, "http://A.example.NET/en/x?q"), (2, None), (3, "no scheme"), (None, "https://net/"), (4, "x://net"), (5, "x://a..net:80/"), (6, "ftp://" + "a." * 5000 + "net/" + "b/" * 5000)], "page_id long, url string")
    rules = literal_rows(spark, url_rules.RULES + [("net", "/b/b/x", "allow")], ["host", "path", "verdict"], ["string"] * 3)
    rows = url_rules.judge_urls(pages.withColumn("rule", F.lit(1)).withColumn("short", F.lit(2)), rules).collect()
    assert len(rows) == 8
    by = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows}
    assert by == {1: ("example.net/en/", "allow"), 2: (None, "allow"), 3: (None, "allow"), None: ("net/", "block"), 4: (None, "allow"), 5: (None, "allow"), 6: ("net/", "block")}
    assert {r["rule"] for r in url_rules.judge_urls(pages, rules.limit(0)).collect()} == {None}
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
    big = url_rules.judge_urls(pages, rules, broadcast_rules=0)
    assert {r["page_id"]: r["verdict"] for r in big.collect()} == {k: v for k, (_, v) in by.items()}


def test_nearest(frame):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [1.0]), (100, [0.0, 1.0]), (7, [0.0, -1.0]), (None, [1.0, 1.0])]
    v = frame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("leaf", F.lit(1))
    out = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in ann.nearest_neighbours(v, v.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert out == [(0, 1, 1, 0.0), (0, 2, 7, 1.414214), (0, 3, 100, 1.414214), (100, 1, 0, 1.414214), (100, 2, 1, 1.414214), (100, 3, 7, 2.0)]
    more = frame([(0, [0.1, 0.7]), (1, [1.0, 0.2]), (200, [1.0, 2.0, 2.0]), (3, [1.0, 2.0, 2.5]), (400, [5.0])], "vec_id long, embedding array<double>")
    exact = {(r["query_id"], r["vec_id"]): r["score"] for r in ann.nearest_neighbours(more, more.where("vec_id % 100 = 0")).collect()}
    assert exact == {(0, 1): (0.9**2 + (0.7 - 0.2) ** 2) ** 0.5, (200, 3): 0.5}  # in double precision; each length by itself
    empty = v.limit(0)
    assert ann.nearest_neighbours(empty, empty).count() == 0


def test_pipeline_stages(spark, docs, labels, frame, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    frame([(1, "no such text in any of the documents at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for at in (docs, docs.limit(0)):
        now = at
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path))
            assert now.columns == at.columns, name
            now.count()
        assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() >= 0
