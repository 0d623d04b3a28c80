"""Each operator on odd rows and on empty tables, against plain Python."""

from __future__ import annotations

import math
import os
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sumstone.llm import (
    fingerprint,
    language,
    mixing,
    neighbours,
    packing,
    quality,
    sharding,
    similarity,
    wavelet,
)
from sumstone.llm.common import freeze, frozen
from sumstone.llm.graph import components
from sumstone.llm.tokens import encode, open_tokenizer
from sumstone.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# ---- sharding


def slow_jump(key: int, shards: int) -> int:
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_is_the_published_recurrence():
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 500)
    for n in (1, 2, 24, 25, 1000):
        assert sharding.jump_buckets(keys, n).tolist() == [slow_jump(int(k), n) for k in keys]


def test_shards_grow_only_into_the_new_one(spark):
    rows = sharding.shard(spark.range(5000), "id", 24).collect()
    assert all(r.grown_shard in (r.shard, 24) for r in rows)
    assert 100 < sum(r.grown_shard == 24 for r in rows) < 320
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 24 and max(sizes.values()) < 1.5 * min(sizes.values())


def test_slots_have_no_gap(odd_documents, no_documents):
    rows = sharding.shard(odd_documents, "doc_id", 3, {"t": F.col("text")}).collect()
    assert len(rows) == odd_documents.count()
    for s in range(3):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert sharding.shard(no_documents, "doc_id", 3).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(odd_documents, "doc_id", 0)


# ---- tokens, packing, wavelet files


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_are_the_tokenizers(odd_documents, path):
    texts = [r.text for r in odd_documents.collect()]
    texts += ["a  b", "x\n\ny", "it's ’s 's", " lead", "trail \n", "İx. ǅ é ́x", "<|endoftext|>", "w. w, .", "tab\there"]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    ids, bounds = encode(path, texts, 7)
    for i, text in enumerate(texts):
        wanted = plain.encode(text or "", add_special_tokens=False).ids + [7]
        assert ids[bounds[i] : bounds[i + 1]].tolist() == wanted


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_of_odd_letters_and_marks_are_the_tokenizers(path):
    odd = ["T̈ab W̊, Å Å.", "İ. İ, ım.", "don't (it's), l'eau ''s", "é×a. ÷b «é». é#1", "क़. שׁ,", "Σας ǅ. K,"]
    odd += ["a\x85b\xa0c\u3000d", "x\x1cy\x1f z\x00", "Ab.cd,EF!!gh 3rd 4,5", "\v\f\r\n", "HALLO### hallo."]
    draw = np.random.default_rng(11)
    signs = list("".join(odd) + " " * 20)
    odd += ["".join(draw.choice(signs, 25)) for _ in range(500)]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for texts in ([*odd, None, ""], pa.array(["left out", None, *odd]).slice(1)):
        ids, bounds = encode(path, texts, 7)
        assert len(bounds) == len(texts) + 1
        for i, text in enumerate(texts if isinstance(texts, list) else texts.to_pylist()):
            wanted = plain.encode(text or "", add_special_tokens=False).ids + [7]
            assert ids[bounds[i] : bounds[i + 1]].tolist() == wanted, text


def test_forms_of_a_word_are_encoded_once():
    texts = ["Qvorxel qvorxel, QVORXEL### qvorxel.", "(qvorxel) qvorxel;"]
    encode(WORDS, texts, 7)
    words = open_tokenizer(WORDS)["words"]
    assert {w for w in words if "vorxel" in w.lower()} == {"qvorxel", "(qvorxel"}


def test_packing_places_each_id_once(odd_documents, no_documents):
    repeated = odd_documents.unionByName(odd_documents)
    for group in (1000, 10_000_000):
        pieces = packing.pack(repeated.coalesce(1), "doc_id", "text", BYTES, 0, capacity=256, group=group)
        rows = pieces.collect()
        by_sequence: dict[int, list] = {}
        for r in rows:
            assert len(r.ids) == 4 * r.length
            by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for places in by_sequence.values():
            ends = 0
            for offset, length in sorted(places):
                assert offset == ends
                ends += length
            assert ends & (ends - 1) == 0 and ends <= 256
        total = sum(len(encode(BYTES, [r.text], 0)[0]) for r in repeated.collect())
        assert sum(r.length for r in rows) == total
        one = sorted((r for r in rows if r.doc_id == 3), key=lambda r: r.start)
        text = odd_documents.filter("doc_id = 3").first().text
        got = Counter()
        for r in one:
            got[r.start, r.length] += 1
        wanted = encode(BYTES, [text], 0)[0]
        assert all(r.ids == wanted[r.start : r.start + r.length].tobytes() for r in one)
    assert packing.pack(no_documents, "doc_id", "text", BYTES, 0).count() == 0


def test_packing_balances_cost():
    lengths = np.random.default_rng(2).integers(1, 400, 400)
    p = packing.place(lengths, 1024, 1.0, 1 / 1024)
    cost = np.bincount(p["sequence"], weights=p["length"] + p["length"] ** 2 / 1024)
    full = np.bincount(p["sequence"], weights=p["length"]) == 1024
    assert cost[full].max() < 1.25 * cost[full].mean()
    assert np.bincount(p["doc"], weights=p["length"]).astype(int).tolist() == lengths.tolist()


def test_wavelet_matrix_reads_like_an_array():
    draw = np.random.default_rng(3)
    for n, top in ((0, 9), (1, 1), (700, 2), (5000, 49_000), (1300, 200_000)):
        ids = draw.integers(0, top, n).astype("<u4")
        ids[::3] = 0
        m = wavelet.WaveletMatrix(wavelet.build(ids, np.array([n])))
        assert m.ids().tolist() == ids.tolist()
        for i in range(0, n, 97):
            assert m.access(i) == ids[i]
            assert m.rank(0, i) == int((ids[:i] == 0).sum())
        places = np.flatnonzero(ids == 0)
        assert m.count(0) == len(places) and m.count(1 << 30) == 0
        assert [m.select(0, k) for k in range(0, len(places), 41)] == places[::41].tolist()
        with pytest.raises(IndexError):
            m.select(0, len(places))
        with pytest.raises(IndexError):
            m.access(n)


def test_wavelet_files_round_trip(spark, odd_documents, no_documents):
    folder = scratch_path(spark, "waves")
    manifest = wavelet.write_shards(odd_documents, "doc_id", "text", WORDS, 2, folder, shard=500)
    rows = wavelet.read_shards(spark, manifest, folder, "doc_id").collect()
    docs = odd_documents.collect()
    key = lambda k: (k is not None, k or 0)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((d.doc_id for d in docs), key=key)
    start = 0
    for r in rows:
        assert r.start == start and len(r.ids) == 4 * r.n_tokens
        start += r.n_tokens
    for d in docs:
        if d.doc_id not in (None, 8):
            wanted = encode(WORDS, [d.text], 2)[0].tobytes()
            assert [r.ids for r in rows if r.doc_id == d.doc_id] == [wanted]
    ends = wavelet.find_token(spark, manifest, folder, 2, "doc_id").collect()
    assert Counter(r.doc_id for r in ends)[8] == 2 and len(ends) >= len(docs)
    empty = wavelet.write_shards(no_documents, "doc_id", "text", WORDS, 2, scratch_path(spark, "waves"))
    assert empty.count() == 0


# ---- classifiers


def test_code_lengths_are_those_of_a_slow_coder(spark):
    docs = spark.createDataFrame([(1, "abab abba", "x"), (2, "bbbb aab", "y")], "i int, t string, l string")
    model = language.train(docs, "t", "l", F.col("i"))
    grams: dict[str, Counter] = {}
    for text, lang in (("   abab abba", "x"), ("   bbbb aab", "y")):
        seen = grams.setdefault(lang, Counter())
        for i in range(3, len(text)):
            seen[text[i - 3 : i + 1]] += 1

    symbol = model["symbol"]

    def chance(lang: str, context: str, c: str) -> float:
        after = Counter()
        for gram, n in grams[lang].items():
            if gram[3 - len(context) : 3] == context:
                after[gram[3]] += n
        shorter = chance(lang, context[1:], c) if context else 1 / language.SYMBOLS
        if not after:
            return shorter
        room = sum(after.values()) + len(after)
        return after[c] / room if after[c] else len(after) / room * shorter

    table = language.cost_table(model)
    text = b"abba"
    got = language.text_costs(table, symbol, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    padded = "   abba"
    for k, lang in enumerate(model["languages"]):
        bits = sum(-math.log2(chance(lang, padded[i - 3 : i], padded[i])) for i in range(3, 7))
        assert got[0, k] == pytest.approx(bits, rel=1e-5)


def test_no_byte_is_merged_with_others(spark):
    # Two scripts that are rare in the sample, beside more than enough frequent bytes.
    common = "".join(chr(c) for c in range(33, 127)) * 200
    rows = [(1, common, "en"), (2, "мир и дом, река и лес", "ru"), (3, "θάλασσα και ουρανός", "el")]
    docs = spark.createDataFrame(rows, "i int, t string, l string")
    model = language.train(docs, "t", "l", F.col("i"))
    asked = spark.createDataFrame([(1, "лес и река"), (2, "ουρανός και θάλασσα"), (3, "$%&AB")], "i int, t string")
    found = {r.i: (r.lang_pred, r.score) for r in language.identify(asked, "t", model).collect()}
    assert [found[i][0] for i in (1, 2, 3)] == ["ru", "el", "en"]
    assert all(score > 0.99 for _, score in found.values())
    ends = language.text_costs(
        language.cost_table(model), model["symbol"], np.frombuffer("мы".encode(), np.uint8), np.array([0, 2, 4])
    )
    assert ends.shape == (2, 3) and (ends > 0).all()


def test_language_of_odd_rows(odd_documents, no_documents):
    model = language.train(odd_documents, "text", "lang", F.col("doc_id"))
    rows = language.identify(odd_documents, "text", model).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1
    assert language.identify(no_documents, "text", model).count() == 0
    untaught = language.train(no_documents, "text", "lang", F.col("doc_id"))
    assert {r.lang_pred for r in language.identify(odd_documents, "text", untaught).collect()} == {"und"}


def test_ratios_and_descent_separate():
    ids = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])]
    label = np.array([1, 1, 0, 0])
    ratio = quality.log_count_ratios(ids, label)
    assert ratio[0] > 0 > ratio[1] and ratio[2] == pytest.approx(ratio[3])
    weight = quality.dual_descent(ids, label, ratio) * ratio
    margins = [weight[i].sum() for i in ids]
    assert min(margins[:2]) > 0 > max(margins[2:])


def test_quality_of_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (8, 0), (9, 0), (4, None), (77, 1), (None, 1), (1, 1)], "doc_id long, quality int"
    )
    model = quality.fit(odd_documents, labels, "text", "doc_id", "quality")
    rows = quality.score(odd_documents, "text", model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[1] == scores[2] > scores[9]
    assert quality.score(no_documents, "text", model).count() == 0
    none = quality.fit(odd_documents, labels.limit(0), "text", "doc_id", "quality")
    assert {r.score for r in quality.score(odd_documents, "text", none).collect()} == {0.5}
    same = quality.fit(odd_documents, labels.filter("quality = 1"), "text", "doc_id", "quality")
    assert {r.score for r in quality.score(odd_documents, "text", same).collect()} == {1.0}


# ---- fingerprints


def slow_paragraphs(text: str) -> Counter:
    found = [x for line in text.split("\n") for x in re.split(r"(?<=[.!?])(?= )", line)]
    return Counter(x for x in found if x)


def test_next_rows_follow_the_order(odd_documents, no_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    docs.sort(key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or ""))
    for size in (1 << 20, 200, 1):
        rows = neighbours.with_next(odd_documents, "doc_id", "text", size).collect()
        got = Counter((r.doc_id, r.text, r.next_text) for r in rows)
        assert got == Counter((*d, n[1] or "") for d, n in zip(docs, docs[1:] + docs[:1]))
    assert neighbours.with_next(no_documents, "doc_id", "text").count() == 0


def test_peeling_finds_the_difference(odd_documents):
    rows = neighbours.with_next(odd_documents, "doc_id", "text")
    out = fingerprint.compare_versions(
        rows, {"p": "text", "q": "next_text"}, {"near": ("text", "next_text")}, ["text", "next_text"]
    ).collect()
    assert len(out) == odd_documents.count()
    for r in out:
        a, b = slow_paragraphs(r.text or ""), slow_paragraphs(r.next_text)
        union = sum((a | b).values())
        assert r.near == pytest.approx(sum((a & b).values()) / union if union else 1.0)
        assert (r.p == r.q) == (a == b)


# ---- similarity


def slow_groups(docs: list[tuple], words: int, num: int, den: int) -> dict:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in docs:
        w = WORD.findall((text or "").translate(lower))
        short = {tuple(w)} if w else set()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or short)
    root = list(range(len(docs)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(docs):
        group = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.append((key, len(sets[i]), min(group) if group else None))
    return Counter(out)


def test_each_class_meets_one_text_however_often_its_key_stands(spark):
    rows = [(None, f"tree {i % 20} stands in wood {i % 20} alone") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = similarity.class_rows(docs, "doc_id", "text", 3, 90, 100, False)
    classes = told.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("_first"))
    members = freeze(classes.selectExpr("*", "monotonically_increasing_id() AS node", "0L AS family", "1L AS trees"), "members")
    found = similarity._texts_of(docs, members, "doc_id", "text", 3)
    texts = [r.text for r in found.collect()]
    assert len(texts) == members.count() == 20 and set(texts) == {text for _, text in rows}


@pytest.mark.parametrize("words,num", [(3, 90), (5, 80)])
def test_groups_of_odd_rows(odd_documents, no_documents, words, num):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    rows = similarity.near_groups(odd_documents, "doc_id", "text", words, num, 100).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == slow_groups(docs, words, num, 100)
    assert similarity.near_groups(no_documents, "doc_id", "text", words, num, 100).count() == 0


@pytest.mark.parametrize("tree", [1 << 21, 600])
@pytest.mark.parametrize("num", [80, 90])
def test_chains_and_large_groups(spark, tree, num):
    """Copies that drift apart, in families of one tree and of many."""
    draw = np.random.default_rng(5)
    docs = []
    for size, copies, edits in ((40, 30, 1), (120, 40, 2), (12, 10, 1), (5, 6, 1)):
        words = [f"w{x}" for x in draw.integers(0, 500, size)]
        for _ in range(copies):
            docs.append((len(docs), " ".join(words)))
            for at in draw.integers(0, size, edits):
                words[at] = f"v{draw.integers(0, 10_000)}"
    base = [f"b{x}" for x in range(200)]
    for _ in range(60):
        other = list(base)
        for at in draw.integers(0, 200, draw.integers(0, 6)):
            other[at] = f"u{draw.integers(0, 10_000)}"
        docs.append((len(docs), " ".join(other)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = similarity.near_groups(frame, "doc_id", "text", 3, num, 100, tree).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == slow_groups(docs, 3, num, 100)


def test_what_only_shares_a_passage_is_parted_before_it_is_compared(spark, monkeypatch):
    """One passage in most texts makes one large family; by their rarest shingles few of it meet."""
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, passage + " " + " ".join(f"own{i % 50} w{i % 50}x{k}" for k in range(12))) for i in range(60)]
    docs += [(100 + i, passage + f" tail{i}") for i in range(3)]
    visits, seen = similarity._visits, []

    def counted(crowd, *args):
        seen.extend(r.node for r in crowd.select("node").collect())
        return visits(crowd, *args)

    monkeypatch.setattr(similarity, "_visits", counted)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = similarity.near_groups(frame, "doc_id", "text", 3, 80, 100, 600).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == slow_groups(docs, 3, 80, 100)
    assert len(seen) < 10


@pytest.mark.parametrize("num", [50, 80, 90, 100])
def test_linked_sets_share_one_of_their_rarest_shingles(spark, monkeypatch, num):
    draw = np.random.default_rng(num)
    common = [f"c{i}" for i in range(30)]
    texts = []
    for i in range(80):
        at = draw.integers(0, len(texts)) if texts and i % 2 else None
        words = list(common) + [f"o{x}" for x in draw.integers(0, 60, 20)] if at is None else texts[at].split(" ")
        for k in draw.integers(0, len(words), draw.integers(0, 4)):
            words[k] = f"e{draw.integers(0, 1000)}"
        texts.append(" ".join(words))
    crowd = spark.createDataFrame([(i, i // 60, t) for i, t in enumerate(texts)], "node long, family long, text string")
    for most in (0, 20, similarity.COMMON):  # any number of common shingles is right
        monkeypatch.setattr(similarity, "COMMON", most)
        held = {}
        for r in similarity._rarest(crowd, "text", 3, num, 100).collect():
            held.setdefault(r.node, set()).add(r.sig)
        split = [t.split(" ") for t in texts]
        sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in split]
        pairs = [(i, j) for i in range(80) for j in range(i) if i // 60 == j // 60]
        linked = [(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
        assert all(held[i] & held[j] for i, j in linked)
        assert linked


def test_signatures_move_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(1, 7), (2, 7), (3, 7), (2, 8), (5, 8), (6, 9), (1, 10), (2, 10)]
    stars = similarity._stars(spark.createDataFrame(rows, "node long, sig long"))
    assert sorted(tuple(r) for r in stars.collect()) == [(2, 1), (3, 1), (5, 2)]
    plan = stars._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(sig#", plan.split("== Initial Plan ==")[-1])) == 1


def test_visits_of_a_family_are_dealt_to_many_tasks(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    texts = [" ".join(f"w{i} v{k}" for k in range(20)) for i in range(40)]
    crowd = spark.createDataFrame([(i, 0, 4, t) for i, t in enumerate(texts)], "node long, family long, trees long, text string")
    links = spark.createDataFrame([(2, 1)], "node long, root long")
    plant = similarity._plant(3, 80, 100, "text")
    found = similarity._visits(crowd, links, plant, "text", 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FlatMapGroupsInArrow.*\n(.*\n)*?.*Exchange hashpartitioning\(family#\d+L, tree#\d+L, block#\d+L", plan)


def test_frozen_queries_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles().mkString("\n").split("\n")
        return {x for x in found if "/shuffle_" in x}

    before = files()
    option = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    rows = freeze(spark.range(1000, numPartitions=4).groupBy((F.col("id") % 10).alias("k")).count(), "tidy")
    deadline = time.time() + 20  # files go a little after the query
    while time.time() < deadline and files() - before:
        time.sleep(0.5)
    assert not files() - before and rows.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == option


def test_rows_frozen_for_a_block_are_removed_behind_it(spark):
    with frozen(spark.range(7), "block") as rows:
        folder = rows.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
        assert rows.count() == 7 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    rows = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in rows} == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}
    assert len(rows) == 111


# ---- mixing


def slow_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.remove(s)


def test_targets_and_rates(spark):
    draw = np.random.default_rng(6)
    rows = []
    for s, (n, top) in {"a": (900, 400), "b": (30, 50), "c": (200, 300), "é": (5, 4000), None: (40, 90)}.items():
        rows += [(len(rows) + i, s, int(x)) for i, x in enumerate(draw.integers(1, top, n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long")
    out = mixing.mix(docs, "doc_id", "source", F.col("words")).collect()
    again = mixing.mix(docs.repartition(5), "doc_id", "source", F.col("words")).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)
    sizes: Counter = Counter()
    taken: Counter = Counter()
    for r in out:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    want = slow_targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 1


def test_repeated_rows_share_copies_evenly(spark):
    """A third of the rows alike, null keys and keys of two sizes: targets are met all the same."""
    rows = [(1, "a", 50, f"t{i}") for i in range(400)] + [(1000 + i, "a", 50, "u") for i in range(800)]
    rows += [(None, "b", 50, "v")] * 300 + [(5000 + i % 2, "b", 40 + 10 * (i % 2), "w") for i in range(1300)]
    rows += [(9000 + i, "c", 7, "x") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long, text string").repartition(7)
    out = mixing.mix(docs, "doc_id", "source", F.col("words")).collect()
    again = mixing.mix(docs.repartition(3), "doc_id", "source", F.col("words")).collect()
    told = lambda found: Counter((r.doc_id, r.source, r.size, r.copies) for r in found)
    assert told(out) == told(again) and len(out) == len(rows)
    assert sorted(r.text for r in out) == sorted(r[3] for r in rows)
    taken, target = Counter(), {}
    for r in out:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s, want in target.items():
        assert abs(taken[s] - want) <= 0.01 * want
    each = [r.copies for r in out if r.doc_id == 1]
    assert max(each) - min(each) <= 2


def test_mix_keeps_columns_of_any_name(spark):
    names = "doc_id, source, size, copies, _source, _key, _size, _doc, _rate, _nth"
    docs = spark.createDataFrame(
        [(i, "ab"[i % 2], 7, "c", i, i + 1, i + 2, i + 3, i + 4, i + 5) for i in range(40)], names.split(", ")
    )
    out = mixing.mix(docs, "doc_id", "source", F.lit(10).cast("long"))
    for r in out.collect():
        i = r.doc_id
        assert (r["_source"], r["_key"], r["_size"], r["_doc"], r["_rate"], r["_nth"]) == tuple(range(i, i + 6))
        assert r.size == 10


def test_two_margins_are_met(spark):
    cells = spark.createDataFrame([(0, 0, 10.0), (0, 1, 30.0), (1, 0, 20.0), (1, 1, 40.0)], "a int, b int, n double")
    a, b = mixing.entropy_balance(cells, ["a", "b"], "n", [np.array([60.0, 40.0]), np.array([30.0, 70.0])])
    got = np.array([[10.0, 30.0], [20.0, 40.0]]) * np.exp(a[:, None] + b[None, :])
    assert got.sum(axis=1) == pytest.approx([60, 40]) and got.sum(axis=0) == pytest.approx([30, 70])


def test_mix_of_odd_rows(odd_documents, no_documents):
    out = mixing.mix(odd_documents, "doc_id", "source", mixing.word_count(F.col("text"))).collect()
    assert len(out) == odd_documents.count()
    for r in out:
        assert r.size == len(WORD.findall(r.text or "")) and 0 <= r.taken <= 3 * r.size
    assert mixing.mix(no_documents, "doc_id", "source", F.lit(1).cast("long")).count() == 0


def test_crc_is_unsigned(spark):
    assert spark.range(1).select(F.crc32(F.lit("xé"))).first()[0] == zlib.crc32("xé".encode())
