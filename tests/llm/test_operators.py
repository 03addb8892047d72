"""Each operator and stage on odd tables, and against brute force on small ones."""

import hashlib
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from loadlens.llm import bpe, catalog, cover_tree, dom, extraction, graphs, mixing, pivots, quality, repeats, simhash, token_counts, url_rules
from loadlens.llm.shared import ready
from tests.llm.test_methods import brute_spans, documents_with_repeats

LONG = "".join(f"word{i % 977} and{i % 31}\n" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
TEXTS = [
    (0, None, "a"),
    (1, "", "a"),
    (2, " \n\t", None),
    (3, "One two THREE four five six seven", "b"),
    (4, "one TWO three four five six seven", "b"),
    (4, "one TWO three four five six seven", "b"),
    (5, LONG, "b"),
    (6, LONG, "a"),
    (7, "x" * 5000, None),
    (8, "é" * 300 + " " + PASSAGE, "c"),
    (9, "Ü" + PASSAGE + " end of it", "c"),
    (None, "no id here, but some text", "a"),
    (None, None, None),
]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with extra columns whose names the operators use inside."""
    ready(spark)
    d = spark.createDataFrame(TEXTS, SCHEMA)
    extra = {c: F.lit(c) for c in ("row", "size", "k1", "score", "node", "fp", "component", "spans", "t", "words", "copy", "taken")}
    return d.withColumns(extra).withColumns({"n_chars": F.length("text").cast("long"), "lang": F.lit("en")})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def folder(odd, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    odd.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (5, 0, 0), (6, 0, 0), (8, 1, 0), (None, 1, 1), (9, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    pages = [(1, None, None), (2, "no scheme", ""), (3, "http://A.Example.NET/en/x?y", "<p>a</p>"), (3, "http://A.Example.NET/en/x?y", "<p>a</p>"), (None, "http://net", "<p")]
    spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit(1), "rule": F.lit(2), "text": F.lit(3)}).write.parquet(f"{path}/pages.parquet")
    v = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (100, [0.9, 0.1]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 0.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0, 0.0]), (8, [1e300, 1e300])]
    spark.createDataFrame(v, "vec_id long, embedding array<double>").withColumns({"node": F.lit(1), "v": F.lit(2), "block": F.lit(3), "label": F.lit(1)}).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="module")
def empty_folder(folder, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in os.listdir(folder):
        spark.read.parquet(f"{folder}/{name}").limit(0).write.parquet(f"{path}/{name}")
    return path


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_odd_and_empty_tables(name, spark, folder, empty_folder):
    """One row per row of the table (top-k: per hit), whatever is in it."""
    rows = catalog.QUERIES[name](spark, folder).collect()
    table = "pages" if name[:4] in ("op6_", "op8_") else "embeddings" if name[:4] in ("op3_", "op9_") else "documents"
    if name[:4] not in ("op3_", "op11", "op12", "op13"):  # these have a row for each hit, piece or word
        assert len(rows) == spark.read.parquet(f"{folder}/{table}.parquet").count()
    assert catalog.QUERIES[name](spark, empty_folder).collect() == []


# ---------------------------------------------------------------- 1


def test_simhash_classes(odd):
    got = simhash.near_duplicates(odd).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert by[0] == by[1] == by[2] == {(0, 0)} and by[3] == by[4] and len(by[4]) == 1 and next(iter(by[3]))[1] == 3
    assert {r["component_id"] for r in got if r["doc_id"] in (5, 6)} == {5}
    assert {(r["fp"], r["component_id"]) for r in got if r["doc_id"] is None} >= {(0, 0)}


@pytest.mark.parametrize("node_rows", [20_000, 5])
def test_simhash_links_equal_all_pairs(spark, node_rows):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    bits = np.unique(np.r_[base, *[base ^ (np.uint64(1) << np.uint64(s)) for s in (0, 20, 21, 41, 63)], np.arange(40, dtype=np.uint64)])
    prints = spark.createDataFrame([(int(x),) for x in bits.view(np.int64)], "fp long")
    got = [frozenset((r["a"], r["b"])) for r in simhash.links(prints, 2, node_rows).collect()]
    signed = bits.view(np.int64).tolist()
    expected = {frozenset((signed[i], signed[j])) for i in range(len(bits)) for j in range(i) if int(bits[i] ^ bits[j]).bit_count() <= 2}
    assert len(got) == len(set(got)) and set(got) == expected


def test_one_of_each_group_stays(spark, odd):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in rng.integers(0, 5000, 400)]
    near = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in (50, 200, 350)]
    other = " ".join(f"w{i}" for i in rng.integers(0, 5000, 400))
    texts = [(9, " ".join(words)), (3, near[0]), (5, near[1]), (7, near[2]), (2, other), (3, near[0]), (None, other)]
    kept = simhash.one_of_each(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == [2, 3]
    assert simhash.one_of_each(odd).columns == odd.columns


def test_near_copies_within_a_template_group(spark):
    """Texts of 0.73 to each other through a shared passage; each pair above 0.8 among them is found."""
    rng = np.random.default_rng(9)
    passage = [f"p{i}" for i in range(240)]
    words = lambda n: [f"w{i}" for i in rng.integers(0, 10**9, n)]
    texts = [passage + words(40) for _ in range(400)]
    copies = [x[:-20] + words(20) for x in texts[:40]]
    rows = [(i, " ".join(x)) for i, x in enumerate(texts + copies)]
    sets = [set(simhash.hashes(x, 5, 42).tolist()) for _, x in rows]
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert all(like(i, 400 + i) > 0.8 for i in range(40)) and max(like(0, i) for i in range(1, 400)) < 0.8
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(400))


@pytest.mark.parametrize("rows", [1_000, 20])
def test_verified_links_connect_what_all_pairs_do(spark, rows):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 40, (12, 60))
    sets = [np.unique(np.r_[base[i % 12][: 60 - i % 7], rng.integers(0, 1 << 40, i % 9)]) for i in range(90)] + [np.empty(0, np.int64)] * 2
    like = lambda x, y: len(np.intersect1d(x, y)) / max(1, len(np.union1d(x, y))) if len(x) + len(y) else 1.0
    a, b = np.array([(i, j) for i in range(92) for j in range(i) if like(sets[i], sets[j]) >= 0.8]).T
    df = spark.createDataFrame([(0, i, x.tolist()) for i, x in enumerate(sets)], "component long, node long, shingles array<long>")
    got = simhash.verified(df, 0.8, rows).collect()
    assert all(like(sets[r["a"]], sets[r["b"]]) >= 0.8 for r in got)
    whole = lambda a, b: dict(zip(*(x.tolist() for x in graphs.forest(a, b, 92)[::-1]), strict=True))
    assert whole(np.array([r["a"] for r in got]), np.array([r["b"] for r in got])) == whole(a, b)


def test_components(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    links = spark.createDataFrame([*path, *star, (7, 7), (200, 199), (1, 0)], "a long, b long")
    got = {r["node"]: r["component"] for r in graphs.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), 199: 199, 200: 199}
    assert graphs.components(links.limit(0)).collect() == []


# ---------------------------------------------------------------- 2, 4


def test_token_counts_read_whole_texts(odd):
    got = {(r["doc_id"], r["c"]["n_pretokens"]): r["c"]["n_tokens"] for r in odd.select("doc_id", token_counts.count(F.col("text"), catalog.RANKS).alias("c")).collect()}
    assert got[0, 0] == got[1, 0] == 0
    trie = token_counts.Trie(token_counts.scores(catalog.RANKS))
    parts = Counter(m.group() for m in token_counts._SPLIT.finditer(LONG))
    assert got[5, sum(parts.values())] == sum(n * trie.count(k.encode()) for k, n in parts.items())


@pytest.mark.parametrize("size", [bpe.PIECE_CHARS, 40])
def test_bpe_equals_the_library_and_round_trips(spark, size):
    with open(catalog.RANKS, "rb") as lines:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [t for _, t, _ in TEXTS] + ["it's  we'll\u00a0x\u2003y\r\n\r\n z <|endoftext|> 𝔘𝔫 12345 " * 30, "a" * 3000, " " * 3000 + "b", "end of a chunk\n" * 90]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    ids = df.select("i", bpe.encode(F.col("text"), catalog.RANKS, size).alias("ids"))
    for r in ids.withColumn("raw", bpe.decode(F.col("ids"), catalog.RANKS)).collect():
        text = texts[r["i"]] or ""
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == plain.encode_ordinary(text)
        assert bytes(r["raw"]) == text.encode()


# ---------------------------------------------------------------- 3, 9


def vectors(spark, seed=0, n=400, copies=120):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16))
    x[50:90] = x[50] + rng.normal(size=(40, 16)) * 0.05
    x[100 : 100 + copies] = x[100]
    ids = rng.permutation(n)
    return spark.createDataFrame([(int(i), [float(y) for y in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>"), ids, x.astype(np.float32).astype(float)


@pytest.mark.parametrize("blocks", [(2_048, 8_192), (3, 50)])
def test_top_k_equals_brute_force(spark, blocks):
    df, ids, x = vectors(spark)
    whole = np.floor(256 * x)
    scores = whole @ whole.T
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in cover_tree.top_k(df, F.col("vec_id") % 50 == 0, 5, 256, *blocks).collect()}
    expected = {}
    for q in np.flatnonzero(ids % 50 == 0):
        best = sorted((-int(scores[q, i]), int(ids[i])) for i in range(len(ids)) if i != q)[:5]
        expected |= {(int(ids[q]), rank): (i, -s) for rank, (s, i) in enumerate(best, 1)}
    assert got == expected


def test_top_k_of_large_components_and_few_rows(spark):
    rows = [(0, [3e9, 1.0]), (1, [2e9, 5.0]), (2, [2e9, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = cover_tree.top_k(df, F.col("vec_id") == 0, scale=1).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 6 * 10**18 + 5), (2, 2, 6 * 10**18 + 4)]


@pytest.mark.parametrize("list_rows", [2_000, 30])
def test_embedding_links_equal_brute_force(spark, list_rows):
    df, ids, x = vectors(spark)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    label = ids.copy()
    for _ in range(len(ids)):
        label = np.minimum(label, np.where(close, label[None, :], len(ids)).min(axis=1))
    got = {r["vec_id"]: r for r in pivots.near_duplicates(df, list_rows=list_rows).collect()}
    found = sum(r["n_links"] for r in got.values())
    assert found >= 0.99 * close.sum() and all(got[i]["n_links"] <= n for i, n in zip(ids.tolist(), close.sum(axis=1).tolist(), strict=True))
    assert all(got[i]["component_id"] == c and got[i]["kept"] == (i == c) for i, c in zip(ids.tolist(), label.tolist(), strict=True))


@pytest.mark.parametrize("list_rows", [2_000, 300])
def test_links_of_a_dense_group_equal_brute_force(spark, monkeypatch, list_rows):
    """A third of the rows are distinct near copies, so a third of the drawn pivots are; every link counts once."""
    rng = np.random.default_rng(12)
    unit = lambda x: x / np.linalg.norm(x, axis=-1)[..., None]
    centre, size, width = unit(rng.normal(size=64)), 1_000, 64
    group = unit(centre + 0.23 * unit(rng.normal(size=(size, width))))
    loose = unit(centre + 0.5 * unit(rng.normal(size=(200, width))))  # linked with some of the group only
    x = np.r_[group, loose, unit(rng.normal(size=(2 * size - 200, width)))]
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    monkeypatch.setattr(pivots, "ROWS_PER_PIVOT", 10)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in pivots.near_duplicates(df, list_rows=list_rows).collect()}
    assert [got[i] for i in range(len(x))] == close.sum(axis=1).tolist()


def test_embedding_index_of_vectors_with_a_common_mean(spark, monkeypatch):
    """Cosine about 0.7 to each other: all near pivots, yet hardly a home is visited; scattered pairs are found."""
    rng = np.random.default_rng(33)
    unit = lambda x: x / np.linalg.norm(x, axis=-1)[..., None]
    mean = unit(rng.normal(size=64))
    x = unit(0.7**0.5 * mean + 0.3**0.5 * unit(rng.normal(size=(3_000, 64))))
    x[1::10] = unit(x[::10] + 0.3 * unit(rng.normal(size=(300, 64))))
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    monkeypatch.setattr(pivots, "ROWS_PER_PIVOT", 10)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    links = {r["vec_id"]: r["n_links"] for r in pivots.near_duplicates(df).collect()}
    assert sum(links.values()) >= 0.95 * close.sum() and all(links[i] <= n for i, n in enumerate(close.sum(axis=1)))
    table = pivots.choose(df.select(F.col("vec_id").alias("node"), F.col("embedding").alias("unit")), 300, 0.9)
    score = x @ table.T
    at_home = (score >= 0.9) & (score == score.max(axis=1)[:, None])
    reach = np.where(at_home.any(axis=0), np.where(at_home, score, 2).min(axis=0), 2)
    assert (score >= pivots.around(reach, 0.9)).sum(axis=1).mean() < 20


def test_a_null_id_is_kept_only_where_all_ids_are_null(spark):
    rows = [(0, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 1.0]), (None, None)]
    got = pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((str(r["vec_id"]), str(r["component_id"]), r["kept"]) for r in got) == [
        ("0", "0", True), ("None", "0", False), ("None", "None", True), ("None", "None", True)
    ]


def test_vectors_that_link_with_nothing(spark, folder):
    got = {r["vec_id"]: r for r in catalog.QUERIES["op9_embedding_near_dedup"](spark, folder).collect()}
    assert [got[i]["n_links"] for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [0] * 8
    assert got[0]["n_links"] == 3 and got[50]["component_id"] == got[100]["component_id"] == got[None]["component_id"] == 0


# ---------------------------------------------------------------- 5


def test_quality_learns_and_holds_out(spark, sf_dir):
    got = catalog.QUERIES["op5_quality_classifier"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality is not null")
    rows = got.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert held and sum(r["predicted"] == r["quality"] for r in held) >= 0.9 * len(held)


def test_rules_are_paths_of_the_trees():
    debug = "Model\n  Tree 0 (weight 1.0):\n    If (feature 1 <= 0.5)\n     If (feature 0 <= 2.0)\n      Predict: 0.0\n     Else (feature 0 > 2.0)\n      Predict: 1.0\n    Else (feature 1 > 0.5)\n     Predict: 1.0\n"
    assert quality.paths(debug, ["a", "b"]) == ["`a` <= 2.0D AND `b` <= 0.5D", "`a` > 2.0D AND `b` <= 0.5D", "`b` <= 0.5D", "`b` > 0.5D"]


@pytest.mark.parametrize("kinds", [[], [1, 1], [0]])
def test_labels_of_one_kind(spark, odd, kinds):
    labels = spark.createDataFrame([(3 + i, k) for i, k in enumerate(kinds)], "doc_id long, quality int")
    scores = {r["score"] for r in quality.score(odd, quality.fit(odd, labels)).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1


# ---------------------------------------------------------------- 6, 8


def test_constant_slots_of_a_host_are_template(spark):
    page = "<body><div><p>Welcome</p></div><div><h1>Title {i}</h1><p>Text {i} &lt;here&gt;</p><p>Read more news</p></div><p>{i}"
    rows = [(i, f"http://h.example/{i}", page.format(i=i)) for i in range(8)] + [(100 + i, "http://other.example/", page.format(i=0)) for i in range(8)]
    ready(spark)
    got = {r["page_id"]: r["text"] for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title {i}\n\nText {i} <here>\n\n{i}" for i in range(8))
    assert all(got[100 + i] == "Welcome\n\nTitle 0\n\nText 0 <here>\n\nRead more news\n\n0" for i in range(8))  # copies teach nothing


def test_template_blocks_that_the_reference_lacks(spark):
    """Whichever page is the reference: an empty one, or one without the block that all others have."""
    page = "<body><div><h1>Title {i}</h1><p>Text {i}</p></div><section><p>Read more news</p></section>"
    bare = "<body><div><h1>Title {i}</h1><p>Text {i}</p></div>"
    ready(spark)
    own = [(i, page.format(i=i)) for i in range(12)]
    rows = [(i, f"http://h{k}.example/", html) for k in range(40) for i, html in [*own, (100, bare.format(i=100 + k)), (101, "" if k % 2 else f"<!-- {k}")]]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {(r["page_id"], r["text"]) for r in got if r["page_id"] < 100} == {(i, f"Title {i}\n\nText {i}") for i in range(12)}


def test_wrapper_finds_main_text_where_classes_say_nothing(spark):
    """Bars, lists and notices without telling names, some of them optional and behind lists of any length."""
    rng = np.random.default_rng(21)
    rows, wanted = [], {}
    for h in range(6):
        for i in range(30):
            own = [f"Host {h} page {i} says {rng.integers(1e9)} and more" for _ in range(rng.integers(1, 8))]
            top = "".join(f"<div><p>Section {h} {k}</p></div>" for k in range(4))
            promo = f"<p>Offer of host {h}</p>" if rng.random() < 0.75 else ""
            end = f"<p>Written by the staff of host {h}</p>" if rng.random() < 0.9 else ""
            box = f"<section><h2>Elsewhere {h}</h2><p>One thing</p><p>Another thing</p></section>" if rng.random() < 0.8 else ""
            at = int(rng.integers(0, len(own) + 1))
            body = "".join(f"<p>{x}</p>" for x in own[:at]) + promo + "".join(f"<p>{x}</p>" for x in own[at:])
            rows.append((len(rows), f"http://h{h}.example/{i}", f"<body><div>{top}</div>{box}<div><h1>Title {h} {i}</h1>{body}{end}</div><div><p>About {h}</p></div>"))
            wanted[len(rows) - 1] = [f"Title {h} {i}", *own]
    ready(spark)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")

    def quality_of(pages):
        got = {r["page_id"]: r["text"].split("\n\n") for r in extraction.extract(pages).collect()}
        good = sum(len(set(got[i]) & set(w)) for i, w in wanted.items())
        return good / sum(map(len, got.values())), good / sum(map(len, wanted.values()))

    precision, recall = quality_of(frame)
    assert precision > 0.95 and recall > 0.95
    alone, whole = quality_of(frame.withColumn("url", F.concat(F.lit("http://"), "page_id", F.lit("/"))))  # hosts of one page
    assert alone < 0.6 and whole > 0.95


def test_merged_tree_has_a_slot_for_blocks_that_the_first_page_lacks():
    pages = ["<p>a</p>", "<p>b</p><section><p>News</p></section>", "<section><p>News</p></section><p>c</p>", ""]
    tree = extraction.Reference(dom.load(dom.dump(extraction.merged(pages))))
    slots = [slot for page in pages for x, slot in extraction.aligned(page, tree) if x.text == "News"]
    assert len(slots) == 2 and min(slots) > 0
    assert extraction.aligned("<table><tr><td>x</table>", tree)[0][1] == -1


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        (None, ("", "", None, "allow")),
        ("example.net/en/", ("", "", None, "allow")),
        ("http://EXAMPLE.net/en/a", ("example.net", "/en/a", "example.net/en/", "allow")),
        ("http://example.net/EN/a", ("example.net", "/EN/a", "net/", "block")),
        ("x://myexample.net/en/?q=/fr/", ("myexample.net", "/en/", "net/", "block")),
        ("http://example.net?x", ("example.net", "", None, "allow")),
        ("http://a.b.org/fr/x#y", ("a.b.org", "/fr/x", "org/fr/", "allow")),
        ("http://example.com/de", ("example.com", "/de", None, "allow")),
        ("http://www.example.com/de/\n", ("www.example.com", "/de/\n", "example.com/de/", "block")),
        ("http://example.net:80/en/", ("example.net:80", "/en/", None, "allow")),
    ],
)
def test_url_rules(spark, url, expected):
    pages = spark.createDataFrame([(1, url)], "page_id long, url string")
    (r,) = url_rules.filter_pages(spark, pages).collect()
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == expected


def test_url_rules_with_special_characters_and_without_broadcast(spark):
    rules = [url_rules.Rule("block", "a+b.net", "/(x)/"), url_rules.Rule("allow", "net", "/"), url_rules.Rule("block", "net", "/")]
    urls = spark.createDataFrame([("http://a+b.net/(x)/1",), ("http://aab.net/(x)/1",)], "url string")
    rows = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in vars(r).items())) for r in rules))
    got = url_rules.judge(urls, spark.range(1).select(F.inline(rows)), few_rules=False).collect()
    assert {(r["host"], r["rule"], r["verdict"]) for r in got} == {("a+b.net", "a+b.net/(x)/", "block"), ("aab.net", "net/", "block")}


# ---------------------------------------------------------------- 7


def test_mixing_meets_targets_by_disjoint_blocks(spark):
    rng = np.random.default_rng(3)
    names = ["a"] * 300 + ["b"] * 40 + ["c"] * 60 + [None] * 30
    docs = [(i, " w" * int(n), s) for i, (n, s) in enumerate(zip(rng.integers(0, 200, len(names)), names, strict=True))] + [(5, " w" * 9, "a")] * 3
    pieces = mixing.mix(spark.createDataFrame(docs, SCHEMA), shards=4, per_shard=16).cache()
    rows = mixing.taken(pieces).collect()
    assert len(rows) == len(docs) and Counter(r["doc_id"] for r in rows)[5] == 4
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        own = by.setdefault(r["source"], [r["target"], 0, r["source_size"]])
        own[1] += r["taken"]
    assert all(0 <= target - taken < 1 and target <= 3 * size for target, taken, size in by.values())
    assert sum(t for t, _, _ in by.values()) == pytest.approx(total)
    # every pass over a document is cut without gaps or overlaps, and shards are of equal size
    seen = {}
    for p in pieces.where("shard is not null").collect():
        seen.setdefault((p["source"], p["start"], p["pass"]), []).append((p["begin"], p["begin"] + p["words"]))
    for cut in seen.values():
        cut.sort()
        assert cut[0][0] == 0 and all(a[1] == b[0] for a, b in zip(cut, cut[1:], strict=False))
    shards = Counter()
    for p in pieces.where("shard is not null").collect():
        shards[p["shard"]] += p["words"]
    assert len(shards) == 4 and max(shards.values()) < 1.2 * min(shards.values())


@pytest.mark.parametrize(("sizes", "shards", "per_shard"), [([5, 5, 5, 5, 5, 5, 5], 16, 64), ([1, 1000, 7], 4, 16), ([1, 1, 1, 0], 2, 1), ([4, 4, 4, 0], 2, 1)])
def test_quotas_add_up_and_shards_are_even(spark, sizes, shards, per_shard):
    frame = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, size long")
    aims = mixing.targets(frame)
    rows = mixing.blocks(aims, shards, per_shard).collect()
    live = aims.where("target >= 1").count()  # a source of a target below 1 draws no word
    assert len(rows) == max(live, shards * per_shard) == len({(r["source"], r["block"]) for r in rows})
    per = Counter(r["shard"] for r in rows)
    assert max(per.values()) - min(per.values(), default=0) <= (live > shards * per_shard)
    if live <= shards * per_shard:
        assert set(per.values()) == {per_shard}
    # contiguous stretches that cover what each source draws
    for i in {r["source"] for r in rows}:
        own = sorted((r["begin"], r["end"]) for r in rows if r["source"] == i)
        assert own[0][0] == 0 and own[-1][1] == rows[[r["source"] for r in rows].index(i)]["drawn"]
        assert all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))


def test_blocks_per_shard_are_hypergeometric(spark):
    """Over many seeds the blocks of a source in a shard have the mean and variance of draws without replacement."""
    frame = spark.createDataFrame([("a", 300), ("b", 100)], "source string, size long")
    aims = mixing.targets(frame).cache()
    drawn = []
    for seed in range(12):
        rows = mixing.blocks(aims, 8, 16, seed).collect()
        quota = sum(r["source"] == "b" for r in rows)
        per = Counter(r["shard"] for r in rows if r["source"] == "b")
        drawn += [per[k] for k in range(8)]
    n, share = 8 * 16, quota / (8 * 16)
    assert np.mean(drawn) == pytest.approx(16 * share)
    assert np.var(drawn) == pytest.approx(16 * share * (1 - share) * (n - 16) / (n - 1), rel=0.35)


def test_mixing_replays_in_any_partitioning(spark, odd):
    a, b = (sorted(map(str, mixing.mix(d).collect())) for d in (odd, odd.repartition(5, "text")))
    assert a == b


# ---------------------------------------------------------------- 10


@pytest.mark.parametrize("contexts", [repeats.CONTEXTS, 1])
def test_repeats_equal_brute_force(spark, contexts):
    texts = documents_with_repeats(11) + [t.encode() for t in ("é" * 400, "aé" * 200, PASSAGE + "!", "?" + PASSAGE)]
    ready(spark)
    df = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r["doc_id"]: r["spans"] for r in repeats.mark(df, contexts=contexts).collect()}
    assert got == dict(enumerate(brute_spans(texts, 200)))


def test_kept_text_keeps_characters_whole(spark):
    ready(spark)
    df = spark.createDataFrame([("aéb", [2, 3]), ("aéb", [1, 3]), ("aéb", [1, 2]), (None, [])], "text string, s array<int>")
    assert [r[0] for r in df.select(repeats.kept_text("text", "s")).collect()] == ["aéb", "ab", "aéb", None]
    assert [bytes(r[0]) for r in df.select(repeats.kept_bytes("text", "s")).collect()] == [b"a\xc3b", b"ab", b"a\xa9b", b""]


# ---------------------------------------------------------------- the pipeline


def test_stages_return_columns_of_documents(spark, odd, empty, folder):
    for name, stage in corpus_pipeline.STAGES:
        got, none = stage(spark, odd, folder), stage(spark, empty, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == odd.columns and none.columns == odd.columns
        got.collect()
        assert none.collect() == []


def test_pipeline_equals_its_stages(spark, sf_dir):
    """The stages' decisions, each made again from what it got, by plain Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ready(spark)
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["quality classifier"](spark, docs, sf_dir).cache()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in clean.collect()}
    known = [r["doc_id"] for r in docs.collect() if r["doc_id"] in labels]
    assert sum((i in kept) == bool(labels[i]) for i in known) >= 0.9 * len(known)

    single = stages["SimHash near-dedup"](spark, clean, sf_dir).cache()
    shingles = {r["doc_id"]: set(simhash.hashes(r["text"], 5, 42).tolist()) for r in clean.collect()}
    left = [r["doc_id"] for r in single.collect()]
    assert len(left) == len(set(left))
    alike = lambda a, b: len(shingles[a] & shingles[b]) >= 0.8 * max(1, len(shingles[a] | shingles[b]))
    for i, a in enumerate(left):
        assert not any(alike(a, b) for b in left[:i])
    for gone in set(shingles) - set(left):
        assert any(alike(gone, b) for b in shingles if b != gone)

    cut = stages["suffix-array dedup"](spark, single, sf_dir).cache()
    before = {r["doc_id"]: r["text"].encode() for r in single.collect()}
    spans = dict(zip(before, brute_spans(list(before.values()), 200), strict=True))
    for r in cut.collect():
        raw, s = before[r["doc_id"]], spans[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
        assert abs(len(r["text"].encode()) - (len(raw) - sum(s[1::2]) + sum(s[::2]))) <= 3 * len(s)

    mixed = stages["mixing sources to target weights"](spark, cut, sf_dir).cache()
    copies = Counter(r["doc_id"] for r in mixed.collect())
    words = {r["doc_id"]: (r["source"], len(r["text"].encode().split())) for r in cut.collect()}
    aims = {r["source"]: r["target"] for r in mixing.targets(cut.select("source", mixing.words(F.col("text")).alias("size"))).collect()}
    for source, target in aims.items():
        taken = sum(copies[i] * n for i, (s, n) in words.items() if s == source)
        assert abs(taken - target) <= 1 + max(n for s, n in words.values() if s == source) / 2
    assert max(copies.values()) <= 3

    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    tokenizer = bpe.tokenizer(catalog.RANKS)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in rows) == copies
    for r in rows:
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == tokenizer.encode_ordinary(texts[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
