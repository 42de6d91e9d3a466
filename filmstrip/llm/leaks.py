"""Evaluation passages inside training documents, by windows of template words and a check of their slots."""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.llm.words import TIME_MARK, folded, words
from filmstrip.plans.skew import salted_join
from filmstrip.session import broadcast_limit, cut, partitions

# Words that stand for numbers or units in a template.
NUMBERS = "không một hai ba bốn năm sáu bảy tám chín mười vài nhiều zero one two three four five six seven eight nine ten several".split()
UNITS = "độ phần trăm giây phút giờ mét km m cm kg g lần degrees percent seconds minutes hours metres meters times".split()
WINDOW, NUMBER, UNIT, NAME = 5, 1, 2, 3
#: Bits of the filter of query windows that documents' windows must pass before they are shuffled: eight megabytes.
FILTER_BITS = 26
_SLOTS = {folded(w): UNIT for w in UNITS} | {folded(w): NUMBER for w in NUMBERS}
_ENDS = re.compile(r"[.!?:|…][\"'”»)]*$")
_TIMES = np.uint64(0x9E3779B97F4A7C15)


def slot(word: str) -> int:
    """NUMBER or UNIT for a word that stands for one, else 0."""
    return NUMBER if word.isdecimal() else _SLOTS.get(word, 0)


@dataclass
class View:
    """Tokens of texts as a template sees them: typed (a slot's number or a word's hash), what a token says (the hash of
    its words), and the word at which it begins."""

    typed: np.ndarray
    said: np.ndarray
    starts: np.ndarray

    def __getitem__(self, part: slice) -> View:
        starts = self.starts[part.start : part.stop + 1]
        return View(self.typed[part], self.said[part], starts - starts[0])


class Vocabulary(dict):
    """Numbers of the pieces between white space, and what is known of each: its words' hashes and slots, whether it is
    capitalised and whether it ends a sentence. The same for every text and query, so it needs no knowledge of either."""

    GAP = "\x00"  # parts texts by unknown words, so that no window spans two

    def __init__(self, most: int = 200_000) -> None:
        super().__init__()
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.count, self.capital, self.end = array("q"), array("b"), array("b")
        self.hashes, self.typed = array("Q"), array("Q")
        self[self.GAP] = 0
        self._add([(0, 0)] * WINDOW, False, True)

    def _add(self, pairs: list[tuple[int, int]], capital: bool, end: bool) -> None:
        self.count.append(len(pairs))
        self.capital.append(capital)
        self.end.append(end)
        self.hashes.extend(h for h, _ in pairs)
        self.typed.extend(t for _, t in pairs)

    def __missing__(self, piece: str) -> int:
        import xxhash

        pairs = []
        for w in words(piece):
            h = (xxhash.xxh3_64_intdigest(w) >> 2) | 8
            pairs.append((h, slot(w) or h))
        first = piece.lstrip("\"'“‘«([|-–—•>")[:1]
        self._add(pairs, first.isupper(), bool(_ENDS.search(piece)))
        self[piece] = n = len(self)
        return n

    def views(self, texts: list[str]) -> tuple[View, View, np.ndarray, np.ndarray]:
        """All texts in one line as two views, without and with names as slots, and where each text's tokens begin in
        either. A name is a capitalised word that doesn't begin a sentence; names and numbers of several words are one."""
        if len(self) > self.most:
            self.forget()
        pieces = [list(map(self.__getitem__, t.split())) for t in texts]
        flat = np.fromiter(chain.from_iterable((*p, 0) for p in pieces), np.int64, sum(map(len, pieces)) + len(pieces))
        count = np.array(self.count, np.int64)
        begin = np.cumsum(count) - count
        size = count[flat]
        total, first = int(size.sum()), np.cumsum(size) - size
        seat = np.arange(total) - np.repeat(first - begin[flat], size)
        said, typed = np.array(self.hashes, np.uint64)[seat], np.array(self.typed, np.uint64)[seat]
        opens = np.r_[True, np.array(self.end, bool)[flat][:-1]]
        name = np.repeat(np.array(self.capital, bool)[flat] & ~opens, size) & (typed == said) & (said > 0)
        named = np.where(name, np.uint64(NAME), typed)
        keep = np.r_[True, ~((named[1:] == named[:-1]) & ((named[1:] == NAME) | (named[1:] == NUMBER)))] if total else np.zeros(0, bool)
        at = np.flatnonzero(keep)
        gaps = np.flatnonzero(flat == 0)
        ends = first[gaps] + WINDOW
        texts_at = np.r_[0, ends[:-1]] if len(ends) else ends
        joined = np.zeros(len(at), np.uint64)
        if total:
            with np.errstate(over="ignore"):
                joined = np.add.reduceat(said * (np.arange(total, dtype=np.uint64) - np.repeat(at, np.diff(np.r_[at, total])).astype(np.uint64) + np.uint64(1)), at)
        return View(typed, said, np.arange(total + 1)), View(named[at], joined, np.r_[at, total]), texts_at, np.searchsorted(at, texts_at)


def window_keys(typed: np.ndarray, seed: int) -> np.ndarray:
    """A key for each window of five tokens; 0 where one of them is unknown."""
    n = len(typed) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key, known = np.full(n, seed, np.uint64), np.ones(n, bool)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            part = typed[k : k + n]
            known &= part > 0
            key = (key ^ (key >> np.uint64(29))) * _TIMES + part
        key ^= key >> np.uint64(32)
    return np.where(known, key | np.uint64(1), np.uint64(0))


def shared_stretch(query: list[int], doc: list[int], at: int, least: int, per: int, starts: list[int] | None = None) -> bool:
    """Whether doc near `at` (where the query would begin) has `least` or more consecutive query words, with at most
    one word put in or exchanged for each `per` words of the stretch, which begins and ends with equal words.

    Maximal equal runs are chained: between two runs the doc may have as many words as the query, or more. starts, if
    given, says at which word each of the query's tokens begins and where the last one ends; then stretches are measured
    by it.
    """
    starts = starts or range(len(query) + 1)
    slack = starts[-1] // per + 1
    lo, hi = max(0, at - slack), min(len(doc), at + len(query) + 2 * slack)
    where = defaultdict(list)
    for d in range(lo, hi):
        where[doc[d]].append(d)
    runs = []
    for q, w in enumerate(query):
        for d in where.get(w, ()) if w else ():
            if abs(d - q - at) <= 2 * slack and not (q and d > lo and query[q - 1] == doc[d - 1]):
                n = 1
                while q + n < len(query) and d + n < hi and query[q + n] == doc[d + n]:
                    n += 1
                if starts[q + n] - starts[q] >= least:
                    return True
                runs.append((q, d, n))
    runs.sort()
    for i, (q0, _, _) in enumerate(runs):
        edits = {i: 0}
        for j in range(i, len(runs)):
            if j not in edits:
                continue
            q, d, n = runs[j]
            span = starts[q + n] - starts[q0]
            if span >= least and edits[j] * per <= span:
                return True
            for k in range(j + 1, len(runs)):
                # a run may begin inside the one before it, as far as that one isn't used
                cut = max(0, q + n - runs[k][0], d + n - runs[k][1])
                dq, dd = runs[k][0] + cut - (q + n), runs[k][1] + cut - (d + n)
                if cut < runs[k][2] and 0 <= dq <= dd <= slack and edits[j] + dd < edits.get(k, slack + 1):
                    edits[k] = edits[j] + dd
    return False


class Bound:
    """What is known of stretches whatever the document: no more of a query's tokens may be missing from it than there
    may be edits. So a part of `least` words or more must exist in which words outweigh missing tokens `per` to one.
    Holds the tokens of all queries of a view in one table, a row a query."""

    def __init__(self, tokens: list[np.ndarray], starts: list[np.ndarray], least: int, per: int) -> None:
        self.per, width = per, max(map(len, tokens), default=0)
        self.tokens = np.full((len(tokens), width), -1, np.int64)
        self.spans = np.zeros((len(tokens), width), np.int64)
        self.reach = np.full((len(tokens), width + 1), -1, np.int64)  # the last place `least` words before each, or -1
        for i, (t, at) in enumerate(zip(tokens, starts)):
            self.tokens[i, : len(t)] = t
            self.spans[i, : len(t)] = np.diff(at)
            self.reach[i, : len(at)] = np.searchsorted(at, at - least, side="right") - 1
        self.size = np.array([len(t) for t in tokens], np.int64)

    def allows(self, query: np.ndarray, line: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For candidates (numbers of queries, parts low..high of the line) whether a stretch isn't ruled out."""
        out = np.zeros(len(query), bool)
        for k in range(0, len(query), 512):
            part = slice(k, k + 512)
            q, a, b = query[part], low[part], high[part]
            seat = a[:, None] + np.arange(int((b - a).max()))
            doc = np.where(seat < b[:, None], line[np.minimum(seat, len(line) - 1)], -2)
            width = int(self.size[q].max())
            missing = ~(self.tokens[q, :width, None] == doc[:, None, :]).any(2)
            weight = np.zeros((len(q), width + 1), np.int64)
            np.cumsum(self.spans[q, :width] - self.per * missing, axis=1, out=weight[:, 1:])
            reach = self.reach[q, : width + 1]
            least = np.take_along_axis(np.minimum.accumulate(weight, 1), np.maximum(reach, 0), 1)
            out[part] = ((reach >= 0) & (weight >= least)).any(1)
        return out


def consistent(query: View, doc: View, hits: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Query and doc as numbers that are equal where the doc says what the query does, each slot's filling exchanged for
    the one that it meets most often in the windows found at `hits` (doc place, query place)."""
    met: dict[tuple[int, int], Counter] = defaultdict(Counter)
    for d, q in hits:
        for k in range(WINDOW):
            kind = int(query.typed[q + k])
            if kind <= NAME:
                met[kind, int(query.said[q + k])][int(doc.said[d + k])] += 1
    put = {slot: min(c, key=lambda v: (-c[v], v != slot[1], v)) for slot, c in met.items()}
    own, other = query.typed.astype(np.int64), doc.typed.astype(np.int64)
    for line, view, fillings in ((own, query, put), (other, doc, {})):
        for i in np.flatnonzero((line > 0) & (line <= NAME)).tolist():
            kind, said = int(line[i]), int(view.said[i])
            line[i] = hash((kind, fillings.get((kind, said), said))) >> 2
    return own, other


class Matcher:
    """Documents against a set of queries that every task holds; its size is checked by leaks()."""

    def __init__(self, queries: list[tuple[str, str]], least: int, per: int) -> None:
        self.least, self.per = least, per
        self.names = [q for q, _ in queries]
        vocabulary = Vocabulary()
        self.queries: list[list[View]] = [[], []]
        for _, text in queries:
            for mine, view in zip(self.queries, vocabulary.views([TIME_MARK.sub(" ", text)])):
                mine.append(view[0 : len(view.typed) - WINDOW])
        self.size = np.array([int(v.starts[-1]) for v in self.queries[0]], np.int64)
        self.slack = self.size // per + 1
        self.windows = [self._index(seed, views) for seed, views in enumerate(self.queries)]
        self.said = Bound([v.said for v in self.queries[0]], [v.starts for v in self.queries[0]], least, per)
        self.typed = [Bound([v.typed for v in views], [v.starts for v in views], least, per) for views in self.queries]

    def _index(self, seed: int, views: list[View]) -> tuple[np.ndarray, ...]:
        """Sorted keys of all windows, and for each the query, the place in it and the key of what it says."""
        keys = [window_keys(v.typed, seed + 1) for v in views]
        flat, none = np.concatenate([*keys, np.zeros(0, np.uint64)]), np.zeros(0, np.int64)
        query = np.repeat(np.arange(len(views)), [len(k) for k in keys])
        place = np.concatenate([none, *(np.arange(len(k)) for k in keys)])
        says = np.concatenate([np.zeros(0, np.uint64), *(window_keys(v.said, seed + 1) for v in views)])
        order = np.argsort(flat, kind="stable")
        return flat[order], query[order], place[order], says[order]

    def hits(self, seed: int, view: View, texts_at: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each window that a text and a query have in common: text, query, the places in both, and whether they
        say the same there."""
        known, query, place, own = self.windows[seed]
        keys = window_keys(view.typed, seed + 1)
        seats = np.flatnonzero(keys)
        first, last = (np.searchsorted(known, keys[seats], side=side) for side in ("left", "right"))
        many = last - first
        seats, first, many = seats[many > 0], first[many > 0], many[many > 0]
        at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many - first, many)
        seats = np.repeat(seats, many)
        text = np.searchsorted(texts_at, seats, side="right") - 1
        says = window_keys(view.said, seed + 1)[seats]
        return text, query[at], seats - texts_at[text], place[at], says == own[at]

    def candidates(self, text: np.ndarray, query: np.ndarray, d: np.ndarray, q: np.ndarray, bound: Bound, line: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, query, where the query would begin) of the neighbourhoods of hits in which a stretch isn't ruled out.
        Diagonals are taken in steps of the slack and one; a stretch strays from a hit of its own by no more than that."""
        step = self.slack[query] + 1
        some = np.unique(np.stack([text, query, (d - q) // step * step]), axis=1)
        text, query, at = some
        low = begin[text] + np.maximum(at - self.slack[query], 0)
        high = np.minimum(begin[text] + at + self.size[query] + 2 * self.slack[query], end[text])
        return list(map(tuple, some[:, bound.allows(query, line, low, high)].T.tolist())) if len(text) else []

    def found(self, texts: list[str], vocabulary: Vocabulary) -> Iterator[tuple[int, int, str]]:
        """(number of the text, number of the query, kind) for each text with a passage of a query: kind 'words' if it
        is in the query's own words, 'template' if slots have other, but consistent, fillings. The first must have two
        windows in common that say the same, as twenty words or more, with one edit in seven, leave no fewer; the second
        one that doesn't."""
        *views, at0, at1 = vocabulary.views([TIME_MARK.sub(" ", t) for t in texts])
        if not self.names or not texts:
            return
        done: set[tuple[int, int]] = set()
        sides = [(view, begin, np.r_[begin[1:], len(view.typed)], self.hits(seed, view, begin)) for seed, (view, begin) in enumerate(zip(views, (at0, at1)))]
        for kind, number in (("words", 1), ("template", 2)):
            for seed, (view, begin, end, hits) in enumerate(sides[:number]):
                text, query, d, q, same = hits
                pair = text * len(self.names) + query
                if kind == "words":
                    keep = same & (np.bincount(pair[same], minlength=len(texts) * len(self.names))[pair] >= 2)
                    bound, line = self.said, view.said
                else:
                    keep = np.bincount(pair[~same], minlength=len(texts) * len(self.names))[pair] >= 1
                    bound, line = self.typed[seed], view.typed
                for n, i, at in self.candidates(*(h[keep] for h in hits[:4]), bound, line.astype(np.int64), begin, end):
                    if (n, i) in done:
                        continue
                    mine, slack = self.queries[seed][i], int(self.slack[i])
                    low = max(0, at - slack)
                    near = view[int(begin[n]) + low : min(int(end[n]), int(begin[n]) + at + int(self.size[i]) + 2 * slack)]
                    own, met = mine.said, near.said
                    if kind == "template":
                        inside = (text == n) & (query == i) & (np.abs(d - q - at) <= slack) & (d >= low) & (d + WINDOW <= low + len(near.typed))
                        own, met = consistent(mine, near, np.stack([d[inside] - low, q[inside]], 1).tolist())
                    if shared_stretch(own.tolist(), met.tolist(), at - low, self.least, self.per, mine.starts.tolist()):
                        done.add((n, i))
                        yield n, i, kind


def leaks(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, least: int = 20, per: int = 7) -> DataFrame:
    """doc_id, query_id, kind for each document with `least` or more consecutive words of a query, one in `per` of them
    at most exchanged or parted by a word put in: kind 'words' if the words are the query's own, 'template' if numbers,
    units or names in it have other fillings, the same one wherever the query repeats one.

    Words are compared without case, accents, Unicode form and punctuation, and time marks don't count. Numbers, units
    and names become typed placeholders. Documents and queries meet in windows of five template words, with names as
    words and with names as placeholders; of the fillings that meet in these windows the commonest is taken for each of
    the query's, and a place where the document has another one counts as an exchanged word, like any other difference.
    A word that is in a name's place counts with the name, so `least` is measured by the query's words.

    Null and blank texts, null ids and queries of fewer than `least` words give no rows; repeated ids give a row once
    for each kind. Other columns are ignored.

    The queries' words are counted. Up to the session's broadcast limit they go to all tasks, and documents are read
    once without a shuffle; beyond it windows of both sides are joined by hash and the pairs checked after the join, in
    the same way. A filter of fixed size of the queries' windows keeps the other windows of documents out of the shuffle.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).dropna()
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query).alias("query")).dropna().distinct()
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, query_id string, kind string"
    q = q.withColumn("query_id", F.col("query_id").cast("string"))
    size = q.agg(F.sum(F.size(F.split("query", r"\s+")))).first()[0] or 0
    if size > broadcast_limit(docs.sparkSession):
        return _joined(d, cut(q), least, per, schema)
    held = sorted((r.query_id, r.query) for r in q.collect() if len(words(r.query)) >= least)
    return d.mapInArrow(_broadcast_pass(held, least, per), schema).distinct()


def _broadcast_pass(held: list[tuple[str, str]], least: int, per: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, vocabulary = Matcher(held, least, per), Vocabulary()
        for batch in batches:
            rows = list(matcher.found(batch.column("text").to_pylist(), vocabulary))
            ids = batch.column("doc_id").take(pa.array([n for n, _, _ in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([matcher.names[q] for _, q, _ in rows], pa.string()), pa.array([k for _, _, k in rows], pa.string())], ["doc_id", "query_id", "kind"])

    return run


def _bits(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (keys * _TIMES) >> np.uint64(64 - FILTER_BITS)


def _joined(d: DataFrame, q: DataFrame, least: int, per: int, schema: str) -> DataFrame:
    """For query sets of any size: the windows of both sides are rows."""
    spark = d.sparkSession

    def explode(own: str, kept=None):  # noqa: ANN001, ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = Vocabulary()
            bits = None if kept is None else np.frombuffer(kept.value, np.uint8)
            for batch in batches:
                *views, a, b = vocabulary.views([TIME_MARK.sub(" ", t) for t in batch.column(1).to_pylist()])
                for seed, (view, at) in enumerate(zip(views, (a, b))):
                    keys = window_keys(view.typed, seed + 1)
                    seats = np.flatnonzero(keys)
                    if bits is not None:
                        place = _bits(keys[seats])
                        seats = seats[(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0]
                    owner = np.searchsorted(at, seats, side="right") - 1
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(keys[seats].view(np.int64))], [own, "key"])

        return run

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[_bits(batch.column("key").to_numpy().view(np.uint64))] = True
        chunks = np.packbits(bits, bitorder="little").reshape(-1, 8192)
        some = np.flatnonzero(chunks.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([chunks[i].tobytes() for i in some], pa.binary())], ["chunk", "bits"])

    def either(group: pa.Table) -> pa.Table:
        every = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in group.column("bits").to_pylist()])
        return pa.table({"chunk": group.column("chunk").slice(0, 1), "bits": pa.array([every.tobytes()], pa.binary())})

    qw = cut(q.mapInArrow(explode("query_id"), "query_id string, key long").distinct())
    parts = qw.select("key").mapInArrow(marked, "chunk int, bits binary").groupBy("chunk").applyInArrow(either, "chunk int, bits binary").collect()  # 1,024 at most
    whole = np.zeros((1 << FILTER_BITS - 16, 8192), np.uint8)
    for r in parts:
        whole[r.chunk] = np.frombuffer(r.bits, np.uint8)
    dw = d.select("doc_id", "text").mapInArrow(explode("doc_id", spark.sparkContext.broadcast(whole.tobytes())), f"{schema.split(',')[0]}, key long").distinct()
    pairs = cut(salted_join(dw, qw, ["key"]).select("doc_id", "query_id").distinct())
    rows = salted_join(pairs.join(d.select("doc_id", "text"), "doc_id"), q, ["query_id"]).select("doc_id", "text", "query_id", "query")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        matcher = lru_cache(1000)(lambda i, w: Matcher([(i, w)], least, per))
        for batch in batches:
            keep, kinds = [], []
            for n, (t, i, w) in enumerate(zip(batch.column("text").to_pylist(), batch.column("query_id").to_pylist(), batch.column("query").to_pylist())):
                for _, _, kind in matcher(i, w).found([t], vocabulary):
                    keep.append(n)
                    kinds.append(kind)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column("doc_id"), kept.column("query_id"), pa.array(kinds, pa.string())], ["doc_id", "query_id", "kind"])

    return rows.repartition(partitions(spark)).mapInArrow(check, schema).distinct()
