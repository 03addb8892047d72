"""The methods inside the tasks against brute force, without Spark."""

import numpy as np
import pytest

from loadlens.llm import cover_tree, dom, extraction, graphs, repeats, simhash, token_counts


def documents_with_repeats(seed, count=40):
    """Random texts with shared passages at the beginning, middle and end, copies, and runs of one character."""
    rng = np.random.default_rng(seed)
    text = lambda n, letters=4: rng.integers(97, 97 + letters, n).astype(np.uint8).tobytes()
    passages = [text(int(n)) for n in rng.integers(150, 700, 5)]
    out = [b"", b"a", text(199), b"z" * 900, b"zy" * 300]
    for _ in range(count):
        parts = [text(int(rng.integers(0, 400)))]
        for _ in range(int(rng.integers(0, 3))):
            p = passages[int(rng.integers(0, 5))]
            cut = int(rng.integers(0, len(p) // 2))
            parts += [p[cut:] if rng.random() < 0.5 else p[: len(p) - cut], text(int(rng.integers(0, 300)))]
        out.append(b"".join(parts))
    return out + out[6:9]


def brute_spans(texts, length):
    where = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            where.setdefault(t[i : i + length], []).append((d, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in where.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + length] = True
    return [np.flatnonzero(np.diff(np.r_[0, g.astype(np.int8), 0])).tolist() for g in gone]


@pytest.mark.parametrize("seed", range(3))
def test_equal_windows_have_equal_anchors(seed):
    texts, length = documents_with_repeats(seed), 200
    raw = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    places, _ = repeats.anchors(np.frombuffer(raw, np.uint8), ends, length)
    chosen = set(places.tolist())
    seen = {}
    for end, t in zip(ends.tolist(), texts, strict=True):
        for i in range(len(t) - length + 1):
            begin = end - len(t) + i
            at = {p - begin for p in range(begin, begin + length - repeats.GRAM + 1) if p in chosen}
            assert at, "a window without an anchor"
            seen.setdefault(t[i : i + length], []).append(at)
    assert all(set.intersection(*x) for x in seen.values())


def test_matches_of_aligned_rows():
    rng = np.random.default_rng(5)
    rows = rng.integers(97, 99, (60, 40)).astype(np.uint8)
    rows[20:30, 5:30] = rows[3, 5:30]
    rows[40:50] = rows[45]
    low, high = rng.integers(0, 8, 60), rng.integers(30, 41, 60)
    group = np.sort(rng.integers(0, 4, 60))
    marked = repeats.matches(rows, low, high, group, 12)
    for i in range(60):
        for c in range(40 - 12 + 1):
            inside = lambda r: low[r] <= c and c + 12 <= high[r]  # noqa: B023, E731
            same = [r for r in range(60) if r != i and group[r] == group[i] and inside(r) and (rows[r, c : c + 12] == rows[i, c : c + 12]).all()]
            assert marked[i, c] == (inside(i) and bool(same)), (i, c)


def test_trie_join_equals_all_pairs():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(s)) ^ (np.uint64(1) << np.uint64(t)) for b in base for s, t in rng.integers(0, 64, (6, 2))]
    bits = np.unique(np.r_[base, np.array(near, np.uint64), np.uint64(0)])
    i, j = simhash.trie_pairs(np.zeros(len(bits), np.int64), bits, 64, 2)
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    expected = {(a, b) for a in range(len(bits)) for b in range(a + 1, len(bits)) if int(bits[a] ^ bits[b]).bit_count() <= 2}
    assert found == expected and len(found) == len(i) > 100
    assert len(simhash.trie_pairs(np.empty(0, np.int64), np.empty(0, np.uint64), 64, 2)[0]) == 0


def test_thinned_pairs_of_a_large_group():
    """A text and many copies of it: every copy keeps its pair with it, and the pairs stay connected."""
    rng = np.random.default_rng(6)
    text = int(rng.integers(0, 1 << 63))
    copies = {text ^ sum(1 << int(b) for b in rng.choice(64, 5, replace=False)) for _ in range(500)}
    bits = np.sort(np.array([text, *copies], np.uint64))
    i, j = simhash.trie_pairs(np.zeros(len(bits), np.int64), bits, 64, 8)
    hub = int(np.searchsorted(bits, np.uint64(text)))
    a, b = simhash.towards_hubs(bits, i, j)
    assert len(i) > 10 * len(bits) >= 5 * len(a) and {*a[b == hub], *b[a == hub]} == set(range(len(bits))) - {hub}
    root, member = simhash.spanning(bits, i, j)
    assert len(member) == len(bits) - 1 and set(root) == {0}
    none = np.empty(0, np.int64)
    assert [len(x) for x in (*simhash.towards_hubs(bits, none, none), *simhash.spanning(bits, none, none))] == [0] * 4


def test_majority_and_shingles():
    assert simhash.majority(np.array([0b11, 0b10], np.uint64)) == 0b10  # half is not over half
    assert simhash.majority(np.empty(0, np.uint64)) == 0
    assert len(simhash.hashes(None, 3, 42)) == 0 and len(simhash.hashes(" \n", 3, 42)) == 0
    assert simhash.hashes("One TWO", 3, 42) == simhash.hashes("one\ttwo", 3, 42)
    assert len(simhash.hashes("a b c a b c", 3, 42)) == 4


@pytest.mark.parametrize("copies", [0, 40])
def test_cover_tree_search_is_exact(copies):
    rng = np.random.default_rng(1)
    points = rng.integers(-60, 60, (700, 8)).astype(float)
    points[:copies] = points[0]
    ids = rng.permutation(700)
    asked = np.flatnonzero(ids % 50 == 0)
    scores, best = cover_tree.search(points[asked], ids[asked], points, ids, 5)
    for row, q in enumerate(asked):
        order = sorted((-(points[q] @ points[p]), ids[p]) for p in range(700) if ids[p] != ids[q])[:5]
        assert [(-s, i) for s, i in zip(scores[row], best[row], strict=True)] == [(s, i) for s, i in order]


def test_cover_tree_covers_and_separates():
    points = np.random.default_rng(3).normal(size=(500, 3))
    todo, seen = [cover_tree.cover_tree(points)], 0
    while todo:
        node = todo.pop()
        assert np.sqrt(((points[node.rows] - node.centre) ** 2).sum(axis=1)).max() <= node.radius
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children]).tolist()) == sorted(node.rows.tolist())
            todo += node.children
        else:
            seen += len(node.rows)
    assert seen == 500


def test_forest_spans_components():
    root, member = graphs.forest(np.array([0, 1, 5, 6, 7]), np.array([1, 2, 6, 7, 5]), 9)
    assert dict(zip(member.tolist(), root.tolist(), strict=True)) == {1: 0, 2: 0, 6: 5, 7: 5}


def test_trie_counts_equal_plain_dynamic_program():
    words = {b"a": -1.0, b"b": -1.5, b"ab": -1.6, b"abc": -3.0, b"c": -2.0, b"bc": -1.7, b"\xc3\xa9": -1.0}
    trie = token_counts.Trie(words, nodes=6)  # so small that it starts anew now and then

    def plain(t):
        best = [(0.0, 0)]
        for e in range(1, len(t) + 1):
            best.append(max((best[s][0] + words.get(t[s:e], token_counts.UNKNOWN), best[s][1] - 1) for s in range(e) if t[s:e] in words or e - s == 1))
        return -best[-1][1]

    for t in (b"", b"a", b"abc", b"abcabc", "aéb".encode(), b"xyz", b"abababcbc", b"ccab"):
        assert trie.count(t) == plain(t) == trie.count(t)


def test_trie_looks_up_only_what_a_token_can_end_with():
    """One long token of the vocabulary does not make every byte of every pre-token try that many pieces."""

    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return dict.get(self, *key)

    words = {b"a": -1.0, b"b": -1.5, b"ab": -1.6, b"x" * 40: -9.0}
    trie, plain = token_counts.Trie(Counted(words)), token_counts.Trie(words)
    if hasattr(trie, "ends"):
        trie.ends = Counted(trie.ends)
    token = b"ab" * 100
    assert trie.count(token) == plain.count(token) == plain.count(token.decode()) == 100
    assert Counted.asked <= 4 * len(token)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body class="with-sidebar">
<!-- <p>no</p> --><nav><a href="/x>y">Menu</a></nav><header><p>Site</p></header><div class="cookie-notice">Accept</div>
<article><header><h1>A &amp; B</h1></header><p>One<b> two.<br>three<p>Four&nbsp;&#233;<ul><li>x<li>y</ul>
<div class="comments"><p>first!</p></div><form><p>mail</p></form></article><aside><p>side</p></aside><footer>F</footer>"""


def test_blocks_of_a_page():
    found = extraction.main_text(extraction.aligned(PAGE, extraction.Reference(dom.parse(""))), {})
    assert found == "A & B\n\nOne two. three\n\nFour é\n\nx\n\ny"


@pytest.mark.parametrize("page", ["", "text only", "<p", "<!--", "<script>x", "</p></div>", "<p>a<p>b</article>", "<" * 50, "<a><b><i>" * 300 + "x"])
def test_broken_pages_do_not_crash(page):
    extraction.main_text(extraction.aligned(page, extraction.Reference(dom.parse(PAGE))), {})
    extraction.main_text(extraction.aligned(PAGE, extraction.Reference(dom.parse(page))), {})


def test_tree_matching_prefers_the_heavier_pairing():
    a = dom.parse("<div class=x><p>1</div><div><p>2<p>3<p>4</div>")
    b = dom.parse("<div><p>2<p>3<p>4</div><div><p>9</div>")
    pairs = dom.match(a, b)
    second = a.children[1]
    assert pairs[second.number] == b.children[0].number and len(pairs) == 5


def test_articles_that_are_teasers_do_not_hide_the_text():
    cards = "<article><a href=x>More</a> news</article>" * 2
    text = "<p>The text of the page itself, which is longer than its cards.</p>"
    for page in (text + cards, f"<main><p>Short.</p></main>{text}{cards}"):
        assert "longer than its cards" in extraction.main_text(extraction.aligned(page, extraction.Reference(dom.parse(""))), {})
    own = extraction.main_text(extraction.aligned(f"<p>Short.</p><article>{text}</article>", extraction.Reference(dom.parse(""))), {})
    assert own == "The text of the page itself, which is longer than its cards."


def test_tree_matching_weighs_what_matches_below():
    """A large content block of other elements does not take the place of the notice behind or before it."""
    notice, content = "<div><p>n<b>1</b></div>", "<div><h2>t</h2><ul><li>1<li>2<li>3</ul></div>"
    for page, reference, place in ((content + notice, notice, (1, 0)), (notice, content + notice, (0, 1))):
        a, b = dom.parse(page), dom.parse(reference)
        assert dom.match(a, b)[a.children[place[0]].number] == b.children[place[1]].number


def test_tree_matching_is_greatest_at_every_length(monkeypatch):
    def size(a, b):
        if a.key != b.key:
            return 0
        best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
        for i, x in enumerate(a.children, 1):
            for j, y in enumerate(b.children, 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + size(x, y))
        return 1 + best[-1][-1]

    rng = np.random.default_rng(8)

    def tree(depth):
        tag = rng.choice(["div", "ul", "h2"])
        return f"<{tag}>{''.join(tree(depth - 1) for _ in range(rng.integers(0, 5)))}</{tag}>" if depth else "<h2></h2>"

    for cells in (dom.CELLS, 4):
        monkeypatch.setattr(dom, "CELLS", cells)
        for _ in range(60):
            a, b = (dom.parse("".join(tree(2) for _ in range(8))) for _ in range(2))
            pairs = dom.match(a, b)
            assert len(pairs) == len(set(pairs.values())) == size(a, b)
