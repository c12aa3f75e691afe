"""Results against brute force, round trips, SQL and held-out labels, on the smallest tables."""

import itertools
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from oracle import connect, differences

import corpus_pipeline
from fieldlens import llm
from fieldlens.llm import _text, ann, decontaminate, language, near_dedup, packing, quality, sharding, toxicity
from fieldlens.llm._common import materialize, scratch

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = llm.registry()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == ([], [])


def test_shards_match_the_mixture(frame):
    rows = [(i, str(i), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2000)]
    out = sharding.shard_documents(frame(rows, "doc_id long, text string, source string"), shards=8).collect()
    shard = {r["doc_id"]: r["shard"] for r in out}
    for source in {s for _, _, s in rows}:
        per = [sum(shard[i] == k for i, _, s in rows if s == source) for k in range(8)]
        assert max(per) - min(per) <= 4  # a cut falls among rows of equal rank, one of each source


def _brute_shingles(text, width):
    import re

    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words)} if 0 < len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def test_shingle_sets(docs):
    texts = [r["text"] for r in docs.collect()] + [None, "", "a", " a  b\nc\td\x0be "]
    hashes, ends = _text.shingle_sets(pa.array(texts), 4)
    assert [len(_brute_shingles(t, 4)) for t in texts] == np.diff(ends).tolist()


def test_dense_groups_are_whole(frame):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(150):  # near copies of one text, some barely similar
        words = base[:]
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(80)] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    sets = [_brute_shingles(t, 4) for _, t in rows]
    root = list(range(150))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(150):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in range(150)}


def test_a_dense_region_is_dense_to_its_end():
    for rest in (1, 5, 40):  # a region that goes on over three batches and ends in the midst of the last one
        parts = [np.arange(200), np.arange(200, 400), np.arange(400, 400 + rest)]
        rows = [(np.ones(len(k), np.int64), k) for k in parts]
        rows[-1] = (np.append(rows[-1][0], [2, 2, 3]), np.append(parts[-1], [900, 901, 902]))
        batches = [pa.RecordBatch.from_arrays([pa.array(r), pa.array(k), pa.array(np.full(len(k), 50)), pa.array(np.zeros(len(k), bool))], ["region", "k", "n", "hot"]) for r, k in rows]
        out = pa.Table.from_batches(near_dedup._neighbours(iter(batches), 0.8)).to_pylist()
        assert {r["a"] for r in out if r["kind"] == 1} == set(range(400 + rest))


def test_pairs_in_a_mass_of_unlike_texts(frame):
    """20,000 texts share a passage (Jaccard 0.35) and are otherwise unlike; 100 of them have a near copy (0.82)."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(40)]
    texts = [[*passage, *(f"w{rng.randrange(10**9)}" for _ in range(34))] for _ in range(20_000)]
    for i in range(100):
        words = texts[i][:]
        words[55], words[71] = "changed", f"c{i}"
        texts.append(words)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i if i < 20_000 else i - 20_000 for i in range(20_100)}


def test_sketches_rule_out_no_similar_pair(frame):
    """A of 100 shingles and B with 25 words more are just similar enough; and so are pairs of all sizes."""
    rng = random.Random(8)
    for size in (1, 4, 100, 3000):
        more = size // 4
        sets = [np.unique(np.array([rng.getrandbits(64) for _ in range(size + more)], np.uint64)) for _ in range(3000 if size <= 100 else 60)]
        part = [np.sort(s[np.array(sorted(rng.sample(range(size + more), size)))]) for s in sets]
        x, y = (near_dedup.sketches(np.concatenate(v), np.concatenate([[0], np.cumsum([len(e) for e in v])])) for v in (part, sets))
        keep, estimate = near_dedup.allowed(x, y, 80)
        assert keep.all() and (estimate >= 0.79).all()
    base = [[f"w{rng.randrange(10**8)}" for _ in range(103)] for _ in range(200)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)] + [(1000 + i, " ".join(w + [f"v{rng.randrange(10**8)}" for _ in range(25)])) for i, w in enumerate(base)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 1000 for i, _ in rows}


def test_hot_regions_in_parts_hide_no_link(frame, monkeypatch):
    """What is left of a crowd when its regions are dealt out in parts of a few rows: all links, by the join."""
    monkeypatch.setattr(near_dedup, "HOT_REGION", 20)
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"w{rng.randrange(10**8)}" for _ in range(rng.randrange(8, 40))])) for i in range(400)]
    rows += [(500 + i, rows[i][1] + " one more") for i in range(0, 400, 7)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert got == _exact_components(rows, 4)


def _exact_components(rows, width):
    """Components by an exact join over shared shingles."""
    sets = {i: _brute_shingles(t, width) for i, t in rows}
    holders: dict[tuple, list] = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        common: dict[int, int] = {}
        for x in sets[a]:
            for b in holders[x]:
                if b < a:
                    common[b] = common.get(b, 0) + 1
        for b, both in common.items():
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_crowds_that_quote_a_text_hide_no_link(frame):
    """Pages that each quote 30 of a text's 40 lines, and a copy of that text with 195 words more; then pages of unequal lengths."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**7)}"
    lines = [" ".join(word() for _ in range(20)) for _ in range(40)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines) + " " + " ".join(word() for _ in range(195)))]
    for i in range(600):
        quoted = sorted(rng.sample(range(40), 30 if i < 300 else rng.randrange(4, 40)))
        rows.append((10 + i, "\n".join(lines[j] for j in quoted) + " " + " ".join(word() for _ in range(rng.choice([3, 3, 60])))))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert got[2] == 1 and got == _exact_components(rows, 4)


def test_packing_round_trip(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.pack_documents(docs, with_ids=True).collect()
    bins: dict[int, list] = {}
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        assert [t for r in own for t in r["ids"]] == exact.encode(text, add_special_tokens=False).ids + [0]
        assert all(r["length"] == 2048 for r in own[1:])
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= sum(r["length"] for r in rows) / 2048 * 1.02 + 1


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(65, np.int64)
    counts[1:] = rng.integers(0, 9, 64) * rng.integers(0, 2, 64)
    plan = packing.plan_patterns(counts, 64)
    placed = np.zeros(65, np.int64)
    for times, sizes in plan:
        assert sum(sizes) <= 64 and times > 0
        for s in sizes:
            placed[s] += times
    assert (placed == counts).all()


def _edit(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row = row, [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (p != t))
    return min(row)


def test_myers_against_the_table():
    rng = random.Random(2)
    for _ in range(200):
        pattern, text = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 30))), "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60)))
        want = _edit(pattern, text)
        got = decontaminate.myers(pattern, text, len(pattern))
        assert (got[0] if got else len(pattern)) == want


def test_edited_passages_are_found(frame):
    rng = random.Random(9)
    items = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(30 if i < 20 else rng.randrange(1, 6)))) for i in range(60)]
    rows, want = [], {}
    for i, (_, text) in enumerate(items):
        chars = list(text)
        for _ in range(i % 8 if i < 20 else i % 3):
            chars[rng.randrange(len(chars))] = rng.choice("xyz")
        rows.append((i, "before it " + "".join(chars).upper() + ", after it"))
        best = _edit(f" {decontaminate.normalise(text)} ", f" {decontaminate.normalise(rows[-1][1])} ")
        if best <= decontaminate.budget(len(decontaminate.normalise(text)), decontaminate.ERROR_RATE):
            want[i] = best
    rows.append((99, "nothing of the sort"))
    got = decontaminate.find_leaks(frame(rows, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: r["distance"] for r in got if r["doc_id"] == r["item_id"]} == want
    for r in got:
        if r["distance"] == 0:
            assert decontaminate.normalise(rows[min(r["doc_id"], 60)][1])[r["start"] : r["end"]] == decontaminate.normalise(items[r["item_id"]][1])


def test_nearest_recall(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = np.array([r["embedding"] for r in vectors.orderBy("vec_id").collect()], float)
    got: dict[int, set] = {}
    for r in ann.op2_nearest(spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert r["score"] == pytest.approx(np.sqrt(((x[r["query_id"]] - x[r["vec_id"]]) ** 2).sum()), abs=1e-12)
    hits = 0
    for q in got:
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits >= 9 * len(got) and len(got) == len(range(0, len(x), 100))


@pytest.mark.parametrize("clustered", [True, False])
def test_recall_of_a_tree_with_many_leaves(frame, clustered):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(4000, 12)) + (rng.normal(size=(40, 12)) * 6)[rng.integers(0, 40, 4000)] * clustered
    x = x.astype(np.float32)
    v = frame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    assert ann.Tree(x.astype(float), 250).n_leaves > 100
    got: dict[int, set] = {}
    for r in ann.nearest_neighbours(v, v.where("vec_id % 100 = 0"), leaf_rows=16).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, found in got.items():
        d = ((x.astype(float) - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(found & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert len(got) == 40 and hits >= 0.9 * 400


def test_restored_words():
    words = {w: 10 for w in "stupid moron trash loser scum pathetic disgusting worthless clown the and".split()}
    model = toxicity.CharacterModel(toxicity.trigrams(words))
    for token, want in {"st*pid": "stupid", "m0r0n": "moron", "tr@sh": "trash", "$cum": "scum", "p4th3t1c": "pathetic", "s.t.u.p.i.d": "stupid", "looooser": "loser", "w0rthle$$": "worthless"}.items():
        assert toxicity.restore(token, model, {}) == want
    assert toxicity.restore("The and$$$ 123 a@", model, {}).startswith("the and$$$ 123")


def _likeliest(token, model):
    """The best reading of a token, of all that its lattice has."""
    best = None
    for path in itertools.product(*toxicity.lattice(token.lower())):
        context, total, word = "\x02\x02", 0.0, ""
        for c, channel in path:
            total = total + channel + (model.cost(context, "\x03" if c == " " else c) if c else 0.0)
            context = "\x02\x02" if c == " " else context[1] + c if c else context
            word += c
        total += model.cost(context, "\x03")
        best = min(best or (total, word), (total, word))
    return best[1]


def test_decoding_finds_the_best_of_all_readings():
    rng = random.Random(8)
    model = toxicity.CharacterModel(toxicity.trigrams({w: rng.randrange(1, 9) for w in "stupid moron trash loser scum bill glass boot see".split()}))
    for _ in range(150):
        token = "".join(rng.choice("stlobe013$@*!. ") for _ in range(rng.randrange(1, 8)))
        assert toxicity.decode(token, model) == _likeliest(token, model), token


def test_the_character_model_counts_all_documents(frame):
    rows = [(i, f"word{chr(97 + i % 26)} alpha" if i % 2 else None) for i in range(400)] + [(400, "漢字 漢字 zebra")]
    model = toxicity.character_model(frame(rows, "doc_id long, text string"))
    words = {"alpha": 8, "zebra": 1, "漢字": 2, **{f"word{chr(97 + i)}": n.bit_length() for i in range(26) if (n := sum(j % 2 and j % 26 == i for j in range(400)))}}
    assert model.tri == toxicity.trigrams(words) and "\x02\x02\u3042" in model.tri and "\x02\x02漢" not in model.tri


def test_long_and_short_disguises_are_restored():
    words = {w: 10 for w in "you are a stupid moron trash loser scum pathetic disgusting worthless clown the and ass".split()}
    model = toxicity.CharacterModel(toxicity.trigrams(words))
    said = "you are a stupid moron and a pathetic loser and a worthless clown"
    restored = lambda text: set(toxicity.restore(text, model, {}).split())
    assert "loser" in restored("l" + "o" * 200 + "ser")
    assert {"you", "are", "moron", "worthless", "clown"} <= restored(".".join(said.replace(" ", "")))
    assert {"you", "are", "moron", "worthless", "clown"} <= restored("".join([said, said]).replace(" ", "").replace("o", "0").replace("a", "4"))
    assert "ass" in restored("a.s.s")
    assert len(toxicity.restore("y0u4r3" * 5_000, model, {})) > 5_000  # in linear time


@pytest.mark.parametrize(("name", "label", "least"), [("op6_toxicity", "toxic", 0.85), ("op10_quality", "quality", 0.9)])
def test_held_out_labels(spark, name, label, least):
    sf = SF.replace("sf0.001", "sf0.01")
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, sf).collect() if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in rows) >= least * len(rows) > 0


def test_held_out_languages(spark, docs):
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = [r for r in QUERIES["op4_language"](spark, SF).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.95 * len(rows) > 0


def test_pipeline_against_its_parts(spark, docs):
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [decontaminate.normalise(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert packed and not any(i in decontaminate.normalise(rows[d]) for d in packed for i in items)
    sets = {d: _brute_shingles(rows[d], 5) for d in packed}
    for a in packed:
        for b in packed:
            both = len(sets[a] & sets[b])
            assert a >= b or not both or 100 * both < 80 * (len(sets[a]) + len(sets[b]) - both)


def test_near_copies_in_the_pipeline_by_brute_force(spark, docs):
    sets = {r["doc_id"]: _brute_shingles(r["text"], 5) for r in docs.collect()}
    least = {d: d for d in sets}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and root(a) != root(b):
            least[max(root(a), root(b))] = min(root(a), root(b))
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert sorted(kept) == sorted(d for d in sets if least[d] == d) and len(kept) < len(sets)


def test_scratch_keeps_the_last_table(frame):
    before = materialize(frame([(0,)], "a int"))
    with scratch() as free:
        first, second = (materialize(frame([(i,)], "a int")) for i in (1, 2))
        places = [df.inputFiles()[0].split(":", 1)[1].replace("//", "") for df in (first, second)]
        free()
        assert [os.path.exists(p) for p in places] == [False, True]
    assert before.count() == 1 and second.first()["a"] == 2


def _naive_phrases(text, sample):
    count, held = 1, ""
    for c in text:
        if held + c in sample:
            held += c
        else:
            count, held = count + 1, c if c in sample else ""
    return count


def test_phrases_are_those_of_a_naive_parse():
    rng = random.Random(11)
    letters = "abcdeäжзиク漢字水火" + "".join(chr(0x4E00 + i) for i in range(300))
    samples = {"a": "".join(rng.choice("abcde ") for _ in range(400)), "b": "".join(rng.choice("abжзи ") for _ in range(300)), "c": "".join(rng.choice(letters) for _ in range(900)), "d": "ab" * 40}
    parser = language.Parser(samples)
    texts = ["", "a", "ab" * 300, *("".join(rng.choice("abcdeжзи ω漢") for _ in range(rng.randrange(1, 300))) for _ in range(25)), samples["c"][100:700], samples["a"][50:] + samples["b"]]
    parts = [parser.squeeze(parser.symbol[language._codes(t)]) for t in texts]
    flat, starts = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    squeeze = lambda t: "".join(chr(0xE000 + s) for s in parser.squeeze(parser.symbol[language._codes(t)]))
    want = [[_naive_phrases(squeeze(t), squeeze(samples[lang])) for lang in parser.languages] for t in texts]
    for segment in (7, 32, 256, 4096):
        assert parser.phrases(flat, starts, segment).tolist() == want


def test_trees_against_naive_ones():
    """Flattened traversal against a walk node by node, and the first tree's root against the best of all cuts."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 9, 400), rng.normal(size=400)])
    y = ((x[:, 0] + 0.3 * x[:, 1] > 1.2) ^ (rng.random(400) < 0.05)).astype(float)
    model = quality.fit(x, y)
    for row, got in zip(x[:60], model.score(x[:60])):
        margin = model.start
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            margin += leaf[node - len(feature)]
        assert got == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-12)
    p = 1 / (1 + np.exp(-model.start))
    g, h = p - y, np.full(len(y), p * (1 - p))
    part = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + 1)
    gains = {}
    for f in range(3):
        for cut in np.unique(np.quantile(x[:, f], np.arange(1, quality.BINS) / quality.BINS)):
            right = x[:, f] > cut
            if min(right.sum(), (~right).sum()) >= quality.LEAST:
                gains[f, cut] = part(right) + part(~right) - part(np.ones(len(y), bool))
    assert gains[model.feature[0][0], model.threshold[0][0]] == pytest.approx(max(gains.values()))


def test_a_repeated_document_is_learned_once(frame):
    docs = frame([(i, f"text number {i} of some words", "en") for i in range(40)] + [(7, "text number 7 of some words", "en")] * 500, "doc_id long, text string, lang string")
    labels = frame([(i, int(i % 2), int(i % 2)) for i in range(40)], "doc_id long, quality int, toxic int")
    once = docs.dropDuplicates()
    assert quality.train(docs, labels).leaf.tolist() == quality.train(once, labels).leaf.tolist()
    assert toxicity.train(docs, labels).weights.tolist() == toxicity.train(once, labels).weights.tolist()
