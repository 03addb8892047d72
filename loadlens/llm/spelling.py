"""Spelling variants: words one edit apart, by composing a vocabulary acceptor with a one-edit transducer and itself.

Words are counted in the whole corpus. Two words that differ by one inserted, deleted or replaced code point agree before
and after the edit, so either the first half of the shorter one is common to both or the rest of it is. Each word is filed
under both halves, for its own length and the one below. The words of one key are what the whole acceptor accepts from the
state its common part leads to: a partition by initial state. There a task builds the minimised acceptors of the shorter
and of the longer words, composes them with the transducer, and reads the pairs that the composition accepts off its
states, each worked out once. A crowded key is halved again in the same way, on the common part it lacks, until one code
point is left; then the alphabet bounds it. A pair belongs to the key that its common prefix names and comes out once.

* null text: no words; null id: counted as the empty id
* long texts, long words and repeated rows are taken whole; each row counts
* ties between near words of equal count: the smaller in code-point order
* extra columns do not matter; an empty table gives no rows
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.shared import stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, LOSS = 5, 3, 97
#: Words of a key that stay together, and of a task.
KEY_WORDS, TASK_WORDS = 10_000, 40_000
_ANY = 2**30

# ---------------------------------------------------------------- words


def occurrences(docs: DataFrame, loss: int = LOSS) -> DataFrame:
    """word, n: the runs of letters of all texts, A-Z lower-cased.

    A code point is lost from every ``loss``-th run, by the crc32 of its document's id and itself, as typing errors are.
    """
    run = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0)))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = docs.select("doc_id", run.alias("run")).withColumn("h", F.crc32(F.encode(key, "UTF-8")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % loss == 0, shorter).otherwise(F.col("run"))
    return runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, loss: int = LOSS) -> DataFrame:
    return occurrences(docs, loss).where((F.length("word") >= least_length) & (F.col("n") >= least_count))


# ---------------------------------------------------------------- acceptors


class Acceptor:
    """The minimal deterministic acceptor of sorted words of one length.

    ``arcs[s]`` maps a letter to (state, number of words accepted from s by smaller letters); 0 is the initial state. So a
    word is known by its number among the sorted words, and ``size[s]`` words are accepted from s.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.size = [0]
        register: dict[tuple, int] = {}
        way: list[tuple[int, str]] = []  # states of the last word that may still get arcs
        before = ""
        for word in words:
            same = 0
            while same < len(before) and word[same] == before[same]:
                same += 1
            self._settle(way, same, register)
            state = self.arcs[way[-1][0]][way[-1][1]][0] if way else 0
            for letter in word[same:]:
                self.arcs.append({})
                self.size.append(0)
                self.arcs[state][letter] = (len(self.arcs) - 1, 0)
                way.append((state, letter))
                state = len(self.arcs) - 1
            self.size[state] = 1
            before = word
        self._settle(way, 0, register)
        self._count(0)

    def _count(self, state: int) -> None:
        if self.arcs[state]:
            total = 0
            for letter, (target, _) in self.arcs[state].items():  # in the order of the letters
                self.arcs[state][letter] = (target, total)
                total += self.size[target]
            self.size[state] = total

    def _settle(self, way: list[tuple[int, str]], length: int, register: dict[tuple, int]) -> None:
        """Put an equal state in the place of each one that gets no more arcs."""
        while len(way) > length:
            state, letter = way.pop()
            target = self.arcs[state][letter][0]
            self._count(target)
            form = tuple((c, t) for c, (t, _) in self.arcs[target].items())
            self.arcs[state][letter] = (register.setdefault(form, target), 0)


class Composition:
    """Short acceptor o one edit o long acceptor; pairs are numbers of words. A state knows its depth, by the one length."""

    def __init__(self, short: Acceptor, long: Acceptor, depth: int):
        self.short, self.long, self.depth = short, long, depth
        self._both: dict[tuple, list[tuple[int, int]]] = {}
        self._replaced: dict[int, list[tuple[int, int]]] = {}
        self._inserted: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def common(self, a: Acceptor, s: int, b: Acceptor, t: int, but: str = "") -> list[tuple[int, int]]:
        """What both accept from their states, as may follow the edit; strings that begin with ``but`` are left out."""
        key = (a is b, s, t, but)
        found = self._both.get(key)
        if found is None:
            if a is b and s == t and not but:
                found = [(i, i) for i in range(a.size[s])]
            elif not a.arcs[s]:
                found = [] if b.arcs[t] else [(0, 0)]
            else:
                found, other = [], b.arcs[t]
                for letter, (u, i) in a.arcs[s].items():
                    if letter in other and letter != but:
                        v, j = other[letter]
                        found += [(i + x, j + y) for x, y in self.common(a, u, b, v)]
            self._both[key] = found
        return found

    def replaced(self, s: int = 0, depth: int = 0) -> list[tuple[int, int]]:
        """Pairs of words of the short acceptor with one letter replaced before ``self.depth``."""
        if depth >= self.depth:
            return []
        if (found := self._replaced.get(s)) is None:
            found, arcs = [], list(self.short.arcs[s].values())
            for k, (t, i) in enumerate(arcs):
                for u, j in arcs[:k]:
                    found += [(j + y, i + x) for y, x in self.common(self.short, u, self.short, t)]
                found += [(i + x, i + y) for x, y in self.replaced(t, depth + 1)]
            self._replaced[s] = found
        return found

    def inserted(self, s: int = 0, t: int = 0, depth: int = 0) -> list[tuple[int, int]]:
        """Pairs (word of the short acceptor, of the long one) with one letter inserted, where the words first differ."""
        if depth >= self.depth:
            return []
        if (found := self._inserted.get((s, t))) is None:
            found, arcs = [], self.short.arcs[s]
            for letter, (u, j) in self.long.arcs[t].items():
                found += [(x, j + y) for x, y in self.common(self.short, s, self.long, u, letter)]
                if letter in arcs:
                    v, i = arcs[letter]
                    found += [(i + x, j + y) for x, y in self.inserted(v, u, depth + 1)]
            self._inserted[s, t] = found
        return found


def near_pairs(short: list[str], long: list[str], depth: int = _ANY) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Pairs one edit apart, as numbers: two of ``short``, and one of ``short`` with one of ``long``.

    Both lists are sorted; all words of ``short`` have one length and those of ``long`` a letter more.
    """
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000 + 4 * max(map(len, [*short[:1], *long[:1]]), default=0)))
    both = Composition(Acceptor(short), Acceptor(long), depth)
    return both.replaced() if len(short) > 1 else [], both.inserted() if long else []


# ---------------------------------------------------------------- keys


def _filed(rows: DataFrame, ends: list[tuple[Column, Column, Column]]) -> DataFrame:
    """Each word under each (lo, hi, cap): ``lo`` code points before and ``hi`` after are common, the prefix below ``cap``."""
    listed = F.array(*[F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), cap.cast("int").alias("cap")) for lo, hi, cap in ends])
    rows = rows.select("word", "n", "m", F.inline(listed)).where("lo < cap")
    head = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    tail = F.substring(F.col("word"), F.length("word") - F.col("hi") + 1, F.col("hi"))
    return rows.withColumn("key", F.concat_ws(" ", "m", "lo", "hi", head, tail))


def keys(words: DataFrame, least_length: int = LEAST_LENGTH, key_words: int = KEY_WORDS) -> DataFrame:
    """word, n, m (length of the shorter words), lo, hi, cap, key.

    A key of one word is left out, and one of over ``key_words`` words is halved until its common part lacks one code point.
    """
    m, lo, hi, cap = F.col("m"), F.col("lo"), F.col("hi"), F.col("cap")
    rows = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m")).where(m >= least_length)
    half = F.floor(m / 2)
    ends = [(half, F.lit(0), F.lit(_ANY)), (F.lit(0), m - half, half)]
    done = None
    while True:
        rows = stored(_filed(rows, ends), "keys")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.first(m - lo - hi).alias("lacks")).where("size > 1")
        crowded = (F.col("size") > key_words) & (F.col("lacks") > 1)
        sized = stored(rows.join(sizes.select("key", crowded.alias("crowded")), "key"), "keys")
        ready = sized.where("not crowded").drop("crowded")
        done = ready if done is None else done.unionByName(ready)
        rows = sized.where("crowded")
        if rows.isEmpty():
            return done
        middle = lo + F.floor((m - lo - hi) / 2)
        ends = [(middle, hi, cap), (lo, m - middle, F.least(cap, middle))]


def _compose(batch: pd.DataFrame) -> pd.DataFrame:
    """Pairs of all keys of a task, in both directions."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    word, length = batch["word"].to_numpy(), batch["word"].str.len().to_numpy()
    m, lo, hi, cap = (batch[c].to_numpy() for c in ("m", "lo", "hi", "cap"))
    for rows in batch.groupby("key", sort=False).indices.values():
        if len(rows) < 2:
            continue
        first, last = lo[rows[0]], hi[rows[0]]
        rest = sorted((length[r], word[r][first : length[r] - last], r) for r in rows)
        short = [(w, r) for n, w, r in rest if n == m[r]]
        long = [(w, r) for n, w, r in rest if n > m[r]]
        if not short:
            continue
        at, at_long = np.array([r for _, r in short]), np.array([r for _, r in long], np.int64)
        replaced, inserted = near_pairs([w for w, _ in short], [w for w, _ in long], int(cap[rows[0]] - first))
        for pairs, there in ((replaced, at), (inserted, at_long)):
            if pairs:
                x, y = np.array(pairs).T
                found += [(at[x], there[y]), (there[y], at[x])]
    a = np.concatenate([np.empty(0, np.int64), *(x for x, _ in found)])
    b = np.concatenate([np.empty(0, np.int64), *(y for _, y in found)])
    n = batch["n"].to_numpy()
    return pd.DataFrame({"word": word[a], "n": n[a], "near": word[b], "near_n": n[b]})


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, key_words: int = KEY_WORDS) -> DataFrame:
    """From distinct (word, n): word, n, near, near_n for every two words one edit apart, in both directions."""
    filed = keys(words, least_length, key_words)
    tasks = max(1, -(-filed.count() // TASK_WORDS))
    task = F.pmod(F.xxhash64("key"), F.lit(tasks)).cast("int")
    return filed.groupBy(task.alias("task")).applyInPandas(_compose, "word string, n long, near string, near_n long")


# ---------------------------------------------------------------- forms and roots


def roots(forms: DataFrame) -> DataFrame:
    """From (word, form): word, root, the end of its chain of forms. A round doubles the steps; chains have no cycle."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = reached.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        moved = stored(moved, "roots")
        reached = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return reached


def variants(words: DataFrame, times: int = 2, least_length: int = LEAST_LENGTH, key_words: int = KEY_WORDS) -> DataFrame:
    """From distinct (word, n): word, form, root, n, n_near, form_n."""
    words = stored(words.select("word", "n"), "words")
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    near = near_words(words, least_length, key_words).unionByName(alone)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("n"), "near"))).alias("best")
    judged = near.groupBy("word", "n").agg(F.count("near").alias("n_near"), best)
    enough = -F.col("best.n") >= times * F.col("n")
    judged = judged.select("word", "n", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n"))
    judged = stored(judged, "forms")
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
