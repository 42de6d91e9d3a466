"""How demanding texts are: n-gram surprisals of whole texts, sentence by sentence, mapped to grades by isotonic regression."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmstrip.llm.words import TIME_MARK, Pieces, words

#: Log odds a change of band must win within a sentence, and at its end.
WITHIN, AT_END = 9.0, 2.0
_ENDS = tuple(".!?…|•>;")


class Bands:
    """Interpolated bigram models of the bands of graded texts.

    The probability of a word after another mixes its share after that word, its share in the band and an equal share
    of all words, by how many different words were seen to follow (Witten and Bell). Words in no graded text count for
    no band.
    """

    def __init__(self, graded: list[tuple[str, int]]) -> None:
        self.bands = sorted({b for _, b in graded})
        seat = {b: i for i, b in enumerate(self.bands)}
        self.ids: dict[str, int] = {}
        uni, bi = [Counter() for _ in self.bands], [Counter() for _ in self.bands]
        for text, band in graded:
            line = [self.ids.setdefault(w, len(self.ids)) for p in text.split() for w in words(p)]
            uni[seat[band]].update(line)
            bi[seat[band]].update(zip(line, line[1:]))
        n, k = len(self.ids), len(self.bands)
        self.alone, self.back = np.zeros((n + 1, k)), np.zeros((n + 1, k))  # the last row: words in no graded text
        self.pairs = np.array(sorted({v * (n + 1) + w for c in bi for v, w in c}), np.int64)
        self.after = np.zeros((len(self.pairs), k))
        for b in range(k):
            total, kinds = sum(uni[b].values()), len(uni[b])
            share = np.array([(uni[b][w] + kinds / n) / (total + kinds) for w in range(n)] or [1.0])
            self.alone[: len(share), b] = np.log(share)
            seen, follow = Counter(), defaultdict(int)
            for (v, _), c in bi[b].items():
                seen[v] += c
                follow[v] += 1
            keep = {v: seen[v] / (seen[v] + follow[v]) for v in seen}
            for v, s in keep.items():
                self.back[v, b] = np.log1p(-s)
            for i, pair in enumerate(self.pairs):
                v, w = divmod(int(pair), n + 1)
                s = keep.get(v, 0.0)
                self.after[i, b] = np.log(s * bi[b][v, w] / max(seen[v], 1) + (1 - s) * share[w])
        if n:
            self.alone[n] = self.alone[:n].mean()

    def piece(self, piece: str) -> int:
        """Twice the id of the piece's word (one in no graded text if it has several unknown, -2 if it has none), plus
        one at the end of a sentence."""
        found = words(TIME_MARK.sub(" ", piece))
        known = [self.ids[w] for w in found if w in self.ids]
        seat = known[0] if known else len(self.ids) if found else -1
        return 2 * seat + (piece.rstrip("\"'”»)").endswith(_ENDS))

    def surprisal(self, seats: np.ndarray) -> np.ndarray:
        """Minus the log probability of each word of a line of ids under each band; 0 where there is no word."""
        n = len(self.ids)
        seats = np.asarray(seats)
        real = np.flatnonzero(seats >= 0)
        out = np.zeros((len(seats), len(self.bands)))
        if not len(real):
            return out
        cur = seats[real]
        prev = np.concatenate([[n], cur[:-1]])
        log = self.alone[cur] + self.back[prev]
        if len(self.pairs):
            keys = prev * (n + 1) + cur
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            hit = self.pairs[at] == keys
            log[hit] = self.after[at[hit]]
        log[cur == n] = self.alone[n]
        out[real] = -log
        return out

    def gist(self, cost: np.ndarray) -> np.ndarray:
        """What isotonic regression maps to the grades: for each row of mean surprisals, one column a band, the mean of
        the bands, each weighing less the more surprising the words are to it."""
        weight = np.exp(cost.min(1, keepdims=True) - cost)
        return weight @ np.array(self.bands, float) / weight.sum(1)

    def decode(self, lines: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """For each text (its pieces' codes) the likeliest band of each piece, bands changing rarely, its surprisal
        under that band, and the gist of the sentences it stands in, which are the pieces between two changes of band:
        so texts without punctuation have sentences too. The gist is that of the mean surprisals of a sentence's words
        under every band; words in no graded text don't count for it, and without any other it isn't a number.
        Texts of like length are worked off side by side."""
        k = len(self.bands)
        order = np.argsort([-len(x) for x in lines], kind="stable")
        bands: list = [np.zeros(0, np.int64)] * len(lines)
        costs: list = [np.zeros(0)] * len(lines)
        gists: list = [np.zeros(0)] * len(lines)
        group: list[int] = []
        groups = []
        for i in order:
            if not len(lines[i]):
                continue
            if group and (len(lines[group[0]]) > 2 * len(lines[i]) + 100 or len(group) * len(lines[group[0]]) > 400_000):
                groups.append(group)
                group = []
            group.append(i)
        for g in [*groups, group] if group else groups:
            size = np.array([len(lines[i]) for i in g])
            codes = np.concatenate([lines[i] for i in g])
            cost = self.surprisal(codes >> 1)
            # step by step: the pieces at place t of all texts that reach it lie side by side, the longest text first
            live = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
            step = np.concatenate([[0], np.cumsum(live)])
            text = np.repeat(np.arange(len(g)), size)
            place = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
            seat = step[place] + text
            cost_at, gate = np.empty((k, len(codes)), np.float32), np.empty(len(codes), np.float32)
            cost_at[:, seat] = cost.T
            gate[seat] = np.where(codes & 1, AT_END, WITHIN)
            came = np.zeros((k, len(codes)), bool)  # whether the band was changed to here
            best = np.zeros(len(codes), np.int8)  # the cheapest band before here
            score = cost_at[:, : len(g)].copy()
            for t in range(1, int(size[0])):
                n, at = live[t], slice(step[t], step[t + 1])
                was = score[:, :n]
                switch = was.min(0) + gate[step[t - 1] : step[t - 1] + n]
                np.argmin(was, 0, out=(low := np.empty(n, np.intp)))
                best[at] = low
                np.less(switch, was, out=came[:, at])
                np.minimum(was, switch, out=was)
                was += cost_at[:, at]
            state, now = np.zeros(len(codes), np.int8), score.argmin(0)
            for t in range(int(size[0]) - 1, -1, -1):
                n, at = live[t], slice(step[t], step[t + 1])
                here = now[:n]
                state[at] = here
                moved = came[:, at][here, np.arange(n)]
                if moved.any():
                    now[:n] = np.where(moved, best[at], here)
            state = state[seat]
            own = cost[np.arange(len(codes)), state]
            first = np.flatnonzero((place == 0) | np.r_[True, state[1:] != state[:-1]])  # where sentences begin
            seats = codes >> 1
            known = (seats >= 0) & (seats < len(self.ids))
            words_in = np.add.reduceat(known, first, dtype=np.int64)
            with np.errstate(invalid="ignore"):
                mean = np.add.reduceat(np.where(known[:, None], cost, 0.0), first, axis=0) / words_in[:, None]
            whole = np.repeat(self.gist(mean), np.diff(np.r_[first, len(codes)]))
            for i, s, z in zip(g, np.cumsum(size) - size, size):
                bands[i], costs[i], gists[i] = state[s : s + z], own[s : s + z], whole[s : s + z]
        return bands, costs, gists

    def codes(self, text: str) -> np.ndarray:
        return np.array([self.piece(p) for p in text.split()], np.int64)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the nondecreasing function of x with the least squares to y: neighbours out of order are pooled."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b in zip(x[order], y[order]):
        pools.append([b, 1.0, a, a])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] >= pools[-1][2]):
            v, n, lo, hi = pools.pop()
            u, m, first, _ = pools[-1]
            pools[-1] = [(u * m + v * n) / (m + n), m + n, first, hi]
    at = np.array([q for p in pools for q in (p[2], p[3])])
    return at, np.array([v for p in pools for v in (p[0], p[0])])


class Levels:
    """Band models and the isotonic map from a sentence's gist to its level, fitted to the gists of held-out samples,
    each of them worked out by models that haven't seen the sample."""

    def __init__(self, graded: list[tuple[str, int]], folds: int = 5) -> None:
        self.models = Bands(graded)
        index, grade = [], []
        for k in range(folds):
            rest = [g for i, g in enumerate(graded) if i % folds != k]
            held = [g for i, g in enumerate(graded) if i % folds == k]
            if rest and held:
                m = Bands(rest)
                for text, band in held:
                    seats = m.codes(text) >> 1
                    known = (seats >= 0) & (seats < len(m.ids))
                    if known.any():
                        index.append(m.gist(m.surprisal(seats)[known].mean(0, keepdims=True))[0])
                        grade.append(band)
        self.held = (np.array(index), np.array(grade, float))
        self.at, self.to = isotonic(*self.held)

    def level(self, gist: np.ndarray) -> np.ndarray:
        """The level of each gist; not a number where the gist is none."""
        return np.interp(gist, self.at, self.to) if len(self.at) else np.full(len(gist), np.nan)


def levels(docs: DataFrame, graded: DataFrame, doc_id: str, text: str, graded_text: str = "text", band: str = "band", most_samples: int = 5000) -> DataFrame:
    """One row per document: doc_id, words, level, median_level, top_share, surprisal_p10, surprisal_p50, surprisal_p90,
    hard_words.

    words are the pieces between white space. The surprisals of all words of the whole text give each sentence a gist,
    which the isotonic map takes to the scale of the graded samples' band. level is the mean of the words' levels, each
    word having its sentence's, and median_level their (lower) median; hard_words counts those nearer to the highest
    band than to the one below it, and top_share is their share. So 2 * hard_words > words says that the level is the
    highest over more than half of the document's distribution. The surprisals (in nats per word, under the band of its
    sentence) are quantiles over all words. Null, blank and wordless texts have 0 words or no known word and null
    levels; rows with a null doc_id are kept. Other columns are ignored.

    The models are fitted on the driver to the graded samples, at most `most_samples` of them, those with the least
    hash; they are a fixed grading key, and what every task gets is a table of their word pairs. Documents are read
    once, whole, and not shuffled.
    """
    key = graded.select(F.col(graded_text).alias("t"), F.col(band).cast("int").alias("b")).dropna().orderBy(F.xxhash64("t", "b"), "t", "b").limit(most_samples).collect()
    if not key:
        raise ValueError("there are no graded samples")
    fitted = Levels([(r.t, r.b) for r in key])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = fitted.models
        codes = Pieces(models.piece)
        above = models.bands[-1] - (models.bands[-1] - models.bands[-2]) / 2 if len(models.bands) > 1 else models.bands[-1]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lines = [np.fromiter(map(codes.__getitem__, (t or "").split()), np.int64) for t in texts]
            _, costs, gists = models.decode(lines)
            out = defaultdict(list)
            for line, cost, gist in zip(lines, costs, gists):
                real, of_word = cost[line >= 0], fitted.level(gist)
                rated = np.sort(of_word[~np.isnan(of_word)])
                hard = int((rated >= above).sum())
                q = np.quantile(real, (0.1, 0.5, 0.9)) if len(real) else (None, None, None)
                mean, median = (float(rated.mean()), float(rated[(len(rated) - 1) // 2])) if len(rated) else (None, None)
                row = (len(line), mean, median, hard / len(line) if len(rated) else None, *q, hard)
                for name, value in zip(names, row):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(out[c], pa.int64() if c in ints else pa.float64()) for c in names)], ["doc_id", *names])

    ints = ("words", "hard_words")
    names = ["words", "level", "median_level", "top_share", "surprisal_p10", "surprisal_p50", "surprisal_p90", "hard_words"]
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} {'long' if c in ints else 'double'}" for c in names))
