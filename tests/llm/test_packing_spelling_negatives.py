"""Bin completion, spelling variants and hard negatives against brute force and on odd tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadlens.llm import bin_completion, catalog, negatives, packing, spelling
from loadlens.llm.shared import ready

# ---------------------------------------------------------------- 11


def least_bins(items, room):
    best = len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for b in {free: b for b, free in enumerate(bins)}.values():
            if bins[b] >= items[i]:
                bins[b] -= items[i]
                go(i + 1, bins)
                bins[b] += items[i]
        go(i + 1, [*bins, room - items[i]])

    go(0, [])
    return best


def is_packing(plan, counts, room):
    held = Counter()
    for filling, times in plan:
        assert times > 0 and sum(x * k for x, k in filling) <= room
        for x, k in filling:
            held[x] += k * times
    return held == Counter(counts)


def test_bin_completion_is_optimal():
    rng = random.Random(1)
    better = 0
    for _ in range(300):
        room = rng.choice([10, 20, 37, 100])
        items = sorted((rng.randint(1, room if rng.random() < 0.5 else room // 2) for _ in range(rng.randint(1, 10))), reverse=True)
        counts = Counter(items)
        plan, fit = bin_completion.pack(counts, room), bin_completion.best_fit(counts, room)
        assert is_packing(plan, counts, room) and is_packing(fit, counts, room)
        assert sum(n for _, n in plan) == least_bins(items, room)
        better += sum(n for _, n in plan) < sum(n for _, n in fit)
    assert better


def test_bin_completion_at_scale_and_at_its_limit():
    rng = np.random.default_rng(0)
    lengths = np.exp(rng.normal(6.4, 1, 200_000)).astype(int) % 2048
    counts = Counter(lengths[lengths > 0].tolist())
    least = -(-sum(x * n for x, n in counts.items()) // 2048)
    assert sum(n for _, n in bin_completion.pack(counts, 2048)) == least
    stopped = bin_completion.pack(counts, 2048, steps=10)
    assert is_packing(stopped, counts, 2048) and sum(n for _, n in stopped) <= least * 1.01
    many = {1500: 10**9, 548: 10**9 - 1, 1: 5 * 10**8}
    assert sum(n for _, n in bin_completion.pack(many, 2048)) == -(-sum(x * n for x, n in many.items()) // 2048)
    assert bin_completion.pack({}, 2048) == []
    with pytest.raises(ValueError):
        bin_completion.pack({2049: 1}, 2048)


def check_places(rows, room):
    """Sequences are gapless from 0 and hold ``room`` at most; returns their number."""
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return len(held)


def test_packing_query(spark, sf_dir):
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = catalog.QUERIES["op11_best_fit_packing"](spark, sf_dir).collect()
    by = defaultdict(dict)
    for r in rows:
        assert r["piece"] not in by[r["doc_id"]]
        by[r["doc_id"]][r["piece"]] = r
    assert by.keys() == texts.keys()
    total = full = 0
    for doc_id, text in texts.items():
        ids = np.array([*made.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        start = 0
        for piece in range(len(by[doc_id])):
            r = by[doc_id][piece]
            part = ids[start : start + r["length"]]
            assert r["start"] == start and r["ids_crc32"] == zlib.crc32(part.tobytes()) and len(part) == r["length"]
            assert r["length"] == 2048 or piece == 0
            start += r["length"]
            full += r["length"] == 2048
        assert start == len(ids)
        total += len(ids)
    assert check_places(rows, 2048) == -(-total // 2048)


def test_hot_lengths_are_ranked_in_buckets(spark):
    rng = np.random.default_rng(3)
    lengths = np.r_[np.ones(2000, int), rng.integers(1, 100, 4000), np.full(300, 100)].tolist()
    items = spark.createDataFrame([(i, x) for i, x in enumerate(lengths)], "item long, length long")
    rows = packing.place(items, room=100, bucket_rows=500).collect()
    assert sorted(r["item"] for r in rows) == list(range(len(lengths)))
    assert check_places(rows, 100) == -(-sum(lengths) // 100)


def test_packed_sequences_and_odd_texts(spark):
    ready(spark)
    long = "".join(f"word{i % 977} and{i % 31}\n" for i in range(20_000))
    docs = spark.createDataFrame([(1, None), (1, None), (2, ""), (None, long), (4, "<|endoftext|> x")], "doc_id long, text string")
    docs = docs.withColumns({"item": F.lit(1), "length": F.lit(2), "row": F.lit(3)})
    packed = packing.pack(docs, catalog.TOKENIZER, keep=("doc_id", "length")).cache()
    rows = packed.collect()
    assert Counter(r["row"]["doc_id"] for r in rows if r["row"]["doc_id"] is not None) == Counter([1, 1, 2, 4])
    made = packing.encoder(catalog.TOKENIZER).made
    whole = np.array([*made.encode(long, add_special_tokens=False).ids, 0], "<u4").tobytes()
    assert b"".join(bytes(r["ids"]) for r in sorted((r for r in rows if r["row"]["doc_id"] is None), key=lambda r: r["piece"])) == whole
    short = next(r for r in rows if r["row"]["doc_id"] == 4)
    assert 50256 not in np.frombuffer(short["ids"], "<u4")
    files = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in files) == sum(len(r["ids"]) for r in rows) and max(len(r["ids"]) for r in files) == 4 * 2048
    packed.unpersist()


def test_ids_are_those_of_the_library(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_CHARS", 200)
    made = packing.Encoder(catalog.TOKENIZER)
    rng = random.Random(4)
    signs = ["a", "é", "ß", " ", "  ", "\n", "\t", "\r\n", "'s", "'ll", "'", "1", "²", "¼", "!", "-", "×", "<|endoftext|>", "word", "\x0b", "ɏ"]
    other = [*signs, "\x85", "\xa0", "漢字", "\u2003", "😀", "\x1c", "é"]
    for listed in (signs, other):
        for _ in range(400):
            text = "".join(rng.choice(listed) for _ in range(rng.randint(0, 60)))
            assert np.frombuffer(made.encode(text), "<u4").tolist() == made.made.encode(text, add_special_tokens=False).ids
    long = "".join(f"word{i % 977} and{i % 31}\n" for i in range(9_000))
    assert np.frombuffer(made.encode(long), "<u4").tolist() == made.made.encode(long, add_special_tokens=False).ids


# ---------------------------------------------------------------- 12


def one_edit(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    x, y = sorted((x, y), key=len)
    return len(x) + 1 == len(y) and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def test_composition_equals_all_pairs():
    rng = random.Random(2)
    for _ in range(300):
        size, letters = rng.randint(1, 6), "abcé"[: rng.randint(1, 4)]
        short = sorted({"".join(rng.choice(letters) for _ in range(size)) for _ in range(20)})
        long = sorted({"".join(rng.choice(letters) for _ in range(size + 1)) for _ in range(20)})
        replaced, inserted = spelling.near_pairs(short, long)
        assert sorted(replaced) == [(a, b) for a in range(len(short)) for b in range(a + 1, len(short)) if one_edit(short[a], short[b])]
        assert sorted(inserted) == [(a, b) for a in range(len(short)) for b in range(len(long)) if one_edit(short[a], long[b])]


def test_acceptor_is_minimal():
    words = sorted(f"{a}{b}ing" for a in "abcd" for b in "xyz")
    acceptor = spelling.Acceptor(words)
    used, todo = {0}, [0]
    while todo:
        for target, _ in acceptor.arcs[todo.pop()].values():
            if target not in used:
                used.add(target)
                todo.append(target)
    assert len(used) == 6 and acceptor.size[0] == len(words)


@pytest.mark.parametrize("key_words", [10_000, 40, 3])
def test_near_words_equal_all_pairs(spark, key_words):
    """Also with crowded keys that are halved again: a third of the words share their first half."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(150)}
    words |= {"prefix" + "".join(rng.choice("abc") for _ in range(6)) for _ in range(80)}
    words |= {"".join(rng.choice("abc") for _ in range(6)) + "suffix" for _ in range(20)} | {"y" * 3000, "y" * 3001}
    words = sorted(words)
    table = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long")
    rows = spelling.near_words(table, key_words=key_words).collect()
    got = [(r["word"], r["near"]) for r in rows]
    assert len(got) == len(set(got))
    assert set(got) == {(x, y) for x in words for y in words if x != y and one_edit(x, y)}
    assert all(words[r["n"] - 3] == r["word"] and words[r["near_n"] - 3] == r["near"] for r in rows)


def test_forms_ties_and_roots(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaaac": 6, "aaabb": 12, "aabbb": 25, "zzzzz": 4, "zzzzzz": 7}
    got = {r["word"]: r for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got["aaaaa"]["form"] == "aaaab" and got["aaaaa"]["root"] == "aabbb" and got["aaaaa"]["n_near"] == 2
    assert got["aabbb"]["form"] is None and got["aabbb"]["root"] == "aabbb" and got["aabbb"]["form_n"] is None
    assert got["zzzzz"]["form"] is None and got["zzzzz"]["n_near"] == 1  # 7 is less than twice 4


def test_words_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "Straße STRASSE straße"), (3, "a" * 70_000)], "doc_id long, text string")
    rows = {r["word"]: r["n"] for r in spelling.occurrences(docs).collect()}
    expected = Counter()
    for doc_id, text in ((None, "Straße STRASSE straße"), (3, "a" * 70_000)):
        for run in text.translate({c: c + 32 for c in range(65, 91)}).split():
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            expected[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    assert rows == expected


# ---------------------------------------------------------------- 13


def test_strassen_is_exact():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n, k, m = rng.integers(1, 90, 3)
        a, b = rng.integers(-(2**28), 2**28, (n, k)), rng.integers(-(2**28), 2**28, (k, m))
        assert (negatives.strassen(a, b, leaf=4) == a @ b).all()
    a, b = rng.integers(-(2**62), 2**62, (20, 21)), rng.integers(-(2**62), 2**62, (22, 21))
    exact = a.astype(object) @ b.astype(object).T
    assert (negatives.products(a, b) == np.clip(exact, -negatives.MOST, negatives.MOST).astype(np.int64)).all()


def mined_by_hand(rows, anchors, k=5):
    vectors = [[int(np.floor(256 * x)) for x in v] for _, v, _ in rows]
    out = []
    for a, (anchor, _, label) in enumerate(rows):
        if not anchors(anchor):
            continue
        score = [sum(x * y for x, y in zip(vectors[a], v, strict=True)) if len(v) == len(vectors[a]) else None for v in vectors]
        others = sorted((i for i in range(len(rows)) if i != a and score[i] is not None), key=lambda i: (-score[i], rows[i][0], i))
        for p in [i for i in others if rows[i][2] == label][:k]:
            fit = [i for i in others if rows[i][2] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(anchor, rows[p][0], rank, rows[i][0], score[p], score[i]) for rank, i in enumerate(fit[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(4_096, 32_768), (3, 40)])
def test_hard_negatives_equal_brute_force(spark, blocks):
    """Ties, repeated rows and anchors, a label of a third of all rows; any tiling gives the same rows."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-2, 4, 6).astype(float).tolist(), int(rng.choice([0, 0, 1, 2, 3]))) for i in range(150)]
    rows += [rows[0], rows[0], rows[40], (151, [1.0, 2.0], 0), (160, [1.0, 1.0], 1), (170, [2.0, 2.0], 0)]
    bad = [(180, None, 1), (190, [float("nan")] * 6, 1), (200, [None] * 6, 0), (210, [1.0] * 6, None), (None, [1.0] * 6, 0), (220, [], 0)]
    table = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>, label int")
    table = table.withColumns({"row": F.lit(1), "v": F.lit(2), "width": F.lit(3), "score": F.lit(4)})
    got = negatives.mine(table, F.col("vec_id") % 10 == 0, F.col("label"), anchor_rows=blocks[0], candidate_rows=blocks[1])
    assert sorted(tuple(r) for r in got.collect()) == mined_by_hand(rows, lambda i: i % 10 == 0)


# ---------------------------------------------------------------- 10


@pytest.mark.parametrize("copies", [1, 200])
def test_copies_of_a_text_give_their_contexts_once(spark, copies):
    """Many copies of a text that shares a passage with other texts: covers are unique, and spans those of brute force."""
    from loadlens.llm import repeats
    from tests.llm.test_methods import brute_spans

    ready(spark)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(420))
    own = ["".join(rng.choice("abcdefgh ") for _ in range(300)) + passage + "".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(12)]
    texts = [*own, *[own[0]] * (copies - 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    raw = F.col("text").cast("binary")
    keyed = docs.select(F.xxhash64(raw).alias("k1"), F.shiftright(F.xxhash64(F.lit(7), raw), 32).alias("k2"), raw.alias("raw"))
    marks = repeats.covers(keyed).select(F.explode("marks").alias("m")).count()
    places = keyed.distinct().mapInArrow(repeats._find(200), repeats.FOUND).count()
    assert marks <= places
    got = {r["doc_id"]: r["spans"] for r in repeats.mark(docs).collect()}
    assert got == dict(enumerate(brute_spans([t.encode() for t in texts], 200)))


def test_a_line_repeated_in_a_text_is_one_row(spark):
    """Lines that texts repeat hundreds of times: a row per text, anchor and context, and the spans of brute force."""
    from loadlens.llm import repeats
    from tests.llm.test_methods import brute_spans

    ready(spark)
    rng = random.Random(12)
    line = "".join(rng.choice("abcdefgh ") for _ in range(150))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(120 + 40 * i)) + line * (3 + 60 * (i % 3)) + "end" * i for i in range(9)] + ["x" * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    raw = F.col("text").cast("binary")
    keyed = docs.select(F.xxhash64(raw).alias("k1"), F.shiftright(F.xxhash64(F.lit(7), raw), 32).alias("k2"), raw.alias("raw"))
    found = keyed.mapInArrow(repeats._find(200), repeats.FOUND)
    assert found.count() == found.select("anchor", "ctx", "k1").distinct().count() < found.agg(F.sum(1 + F.coalesce(F.size("more"), F.lit(0)))).first()[0] / 5
    for contexts in (repeats.CONTEXTS, 3):
        got = {r["doc_id"]: r["spans"] for r in repeats.mark(docs, contexts=contexts).collect()}
        assert got == dict(enumerate(brute_spans([t.encode() for t in texts], 200)))


# ---------------------------------------------------------------- 1


@pytest.mark.parametrize("errors", [2, 8])
@pytest.mark.parametrize("held", [50, 2_000_000])
def test_thinning_loses_no_component(spark, monkeypatch, errors, held):
    """Chains of fingerprints: components are those of brute force, however few pairs a task may hold."""
    from loadlens.llm import graphs, simhash

    monkeypatch.setattr(simhash, "HELD_PAIRS", held)
    rng = np.random.default_rng(10)
    prints = []
    for _ in range(40):
        x = int(rng.integers(0, 1 << 63))
        for _ in range(20):
            prints.append(x)
            for bit in rng.choice(64, errors, replace=False):
                x ^= 1 << int(bit)
    prints = np.unique(np.array(prints, np.uint64))
    order = np.arange(len(prints))
    frame = {"kind": 0, "band": None, "value": None, "key": 0, "fp": None}
    rows = []
    for i, (low, width) in enumerate(simhash._bands([(0, 64)], errors + 1)):
        value = (prints >> np.uint64(low)) & np.uint64((1 << width) - 1)
        rows += [{**frame, "band": str(i), "value": [int(v)], "fp": int(np.int64(np.uint64(p).view(np.int64)))} for p, v in zip(prints, value, strict=True)]
    import pandas as pd

    batch = pd.DataFrame(rows)
    links = pd.concat(simhash._joined(errors, simhash.spanning)(iter([batch])))
    place = {int(p): i for i, p in enumerate(prints.view(np.int64).tolist())}
    a, b = (np.array([place[int(x)] for x in links[c]], np.int64) for c in ("a", "b"))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= errors
    i, j = np.nonzero(near & (order[:, None] < order[None, :]))
    parts = lambda x, y: len(prints) - len(graphs.forest(x, y, len(prints))[1])
    assert parts(a, b) == parts(i, j)
    assert parts(np.r_[a, i], np.r_[b, j]) == parts(i, j)


@pytest.mark.parametrize("node_rows", [20_000, 3])
def test_links_of_eight_bits_equal_all_pairs(spark, node_rows):
    """Pairs agree in two bands at least; also those whose differing bits leave just two, and each pair comes once."""
    from loadlens.llm import simhash

    rng = np.random.default_rng(21)
    base = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    cut = simhash._pair_cut(8)
    spread = [sum(1 << low for k, (low, _) in enumerate(cut) if k not in skip) for skip in ((0, 1), (8, 9), (3, 7))]
    near = [base ^ np.uint64(x) for x in spread]
    near += [np.array([int(x) ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 10)), replace=False)) for x in base], np.uint64)]
    bits = np.unique(np.r_[base, *near, np.arange(60, dtype=np.uint64)])
    prints = spark.createDataFrame([(int(x),) for x in bits.view(np.int64)], "fp long")
    got = [frozenset((r["a"], r["b"])) for r in simhash.links(prints, 8, node_rows).collect()]
    signed = bits.view(np.int64)
    i, j = np.nonzero(np.triu(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 8, 1))
    assert len(got) == len(set(got)) and set(got) == {frozenset(x) for x in zip(signed[i].tolist(), signed[j].tolist(), strict=True)}


def test_a_task_compares_rows_of_two_common_bands_only(monkeypatch):
    """The pairs that are looked at grow with far less than the rows of a band value squared."""
    import pandas as pd

    from loadlens.llm import simhash

    looked = []
    plain = simhash._leaf_pairs
    monkeypatch.setattr(simhash, "_leaf_pairs", lambda bits, a0, a1, b0, b1, *more: (looked.append(int(((a1 - a0) * (b1 - b0)).sum())), plain(bits, a0, a1, b0, b1, *more)))
    fp = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 6000)
    name, (low, width) = next(iter(simhash._bands_of(8).items()))
    fp = fp >> (low + width) << (low + width)
    frame = pd.DataFrame({"kind": 0, "band": name, "value": [[0]] * len(fp), "key": 0, "fp": np.unique(fp)})
    list(simhash._joined(8, simhash.spanning)(iter([frame])))
    assert 0 < sum(looked) < len(fp) ** 2 / 4
