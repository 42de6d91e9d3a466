"""Texts that are template residue, filler, error messages or script notices, by a linear model on hashed n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmstrip.functions.fold import fold
from filmstrip.llm.words import folded
from filmstrip.session import cut

# Phrases and response statuses that make a weak label, on folded text (no case, no accents).
PLACEHOLDER = [r"\{\{?[^{}]*\}\}?", r"\$\{", r"%\(\w+\)s", r"%s", r"_{3,}", r"__\w+__", r"@@\w+@@", r"<[a-z][^<>]*>", r"&lt;", r"\[[a-z +\-]{2,}\]", r"\bnn\b.*\.\.\."]
FILLER = [r"\blorem ipsum\b", r"\b(?:todo|tbd|fixme)\b", r"(?:^|[:\-] )(\w{3,})(?: \1)+\b|\b(\w{3,})(?: \2)+\W*$", r"placeholder|giu cho|noi dung that", r"van ban mau van ban mau", r"sample text|default caption|mo ta mac dinh", r"cau vi du so", r"(?:se|dang) (?:duoc )?(?:hien thi|bo sung|cap nhat)", r"nhap van ban|goes here|tai day$"]
STATUS = [r"\b(?:http )?[45]\d\d\b *[-|:]? *[a-z]", r"traceback|exception|\berror\b", r"\bloi api\b|da xay ra loi|rat tiec", r"het (?:quota|han muc)", r"khong tim thay|khong ton tai|khong phan hoi|qua han", r"\bma \d{2,}\b", r"(?:too many requests|access denied|something went wrong|session expired|try again)", r"ket noi bi tu choi|connect error|tam ngung|qua nhieu yeu cau", r"gateway|forbidden|timeout|time-out"]
SCRIPTS = [r"noscript", r"javascript|\bjs\b", r"\bscripts?\b|ma lenh"]
#: How descriptions report words that are seen in the picture.
REPORTED = [r"bien hieu", r"thong bao", r"in chu", r"co chu", r"in nhan", r"\bviet\b.* len bang", r"treo bang", r"\bhien (?!thi)", r"chay ngang man hinh", r"\breads?\b", r"\ba sign\b", r"\bshirt with\b", r"\bnotice\b", r"\bon the board\b", r"\blabel\b", r"\bprinted\b", r"\bscreen\b"]
FAMILIES = {"placeholder": PLACEHOLDER, "filler": FILLER, "status": STATUS, "scripts": SCRIPTS}
BITS, SIZES, DENSE, SCALE = 18, (3, 4, 5), 6, 0.1
_PARTS = re.compile(r"(?<=[.!?…])\s+|\n+")
_SEEN = re.compile(r"(?ims)^\s*TEXT:.*\Z")


def parts(text: str) -> list[str]:
    """Sentences and lines of a text, without the last line TEXT: that lists words seen on screen."""
    return [p for p in (x.strip() for x in _PARTS.split(_SEEN.sub("", text))) if p]


def parts_column(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.regexp_replace(text, _SEEN.pattern.replace(r"\Z", r"\z"), ""), _PARTS.pattern), lambda p: F.trim(p)), lambda p: p != "")


def plain(part: Column) -> Column:
    return F.translate(fold(part), "｛｝［］＜＞＄％＿＠", "{}[]<>$%_@")


def matches(part: Column, families: list[str]) -> Column:
    """Whether a phrase or status of one of the families is in the part."""
    return plain(part).rlike("|".join(p for f in families for p in FAMILIES[f]))


def weak_label(part: Column, families: list[str] = list(FAMILIES)) -> Column:
    """1 for a phrase or status of residue, 0 for none, 2 where a description reports such words as seen (none too);
    null for long texts of the last kind, which may have both."""
    return F.when(~matches(part, families), 0).when(plain(part).rlike("|".join(REPORTED)), F.when(F.length(part) < 120, 2)).otherwise(1)


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed character n-grams and word pairs of all texts in one line, where each text's begin, and dense features:
    length, the shares of capitals, digits, marks and capitalised words, and whether it ends like a sentence."""
    plain = [re.sub(r"\d", "0", f"\x02{folded(t)}\x03") for t in texts]
    raw = [p.encode() for p in plain]
    size = np.array([len(r) for r in raw], np.int64)
    line = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    grams, owners = [], []
    owner = np.repeat(np.arange(len(texts)), size)
    with np.errstate(over="ignore"):
        for n in SIZES:
            if len(line) < n:
                continue
            key = np.full(len(line) - n + 1, n, np.uint64)
            for k in range(n):
                key = (key ^ line[k : len(line) - n + 1 + k]) * np.uint64(0x100000001B3)
            within = owner[: len(key)] == owner[n - 1 :]
            grams.append((key[within] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
            owners.append(owner[: len(key)][within])
    flat = np.concatenate(grams).astype(np.int64) if grams else np.zeros(0, np.int64)
    whose = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    order = np.argsort(whose, kind="stable")
    flat, whose = flat[order], whose[order]
    dense = np.zeros((len(texts), DENSE))
    for i, t in enumerate(texts):
        w, n = t.split(), max(len(t), 1)
        dense[i] = (np.log1p(n) / 5, sum(map(str.isupper, t)) / n, sum(map(str.isdigit, t)) / n, sum(not c.isalnum() and not c.isspace() for c in t) / n, sum(x[:1].isupper() for x in w) / max(len(w), 1), t.rstrip()[-1:] in ".!?")
    return flat, whose, dense


class Linear:
    """Logistic regression on hashed n-grams, with a squared penalty on its weights; full gradients, adapted steps."""

    def __init__(self, texts: list[str] = (), labels: list[int] = (), counts: list[int] = (), penalty: float = 1e-5, rounds: int = 120, step: float = 0.3) -> None:
        flat, whose, dense = hashed(texts)
        kind = np.array(labels, int)
        y, each = (kind == 1).astype(float), np.zeros(len(kind))
        for label, weight in ((0, 0.25), (1, 0.5), (2, 0.25)):
            part = np.log1p(np.array(counts, float)) * (kind == label)  # what is common weighs more, but not as much more
            each += weight * part / max(part.sum(), 1e-9)
        self.w, self.d, self.b = np.zeros(1 << BITS), np.zeros(DENSE), 0.0
        gw, gd, gb = np.full(1 << BITS, 1e-8), np.full(DENSE, 1e-8), 1e-8
        for _ in range(rounds):
            err = (self._p(flat, whose, dense, len(y)) - y) * each
            g = np.bincount(flat, weights=(err * SCALE)[whose], minlength=1 << BITS) + penalty * self.w
            h, e = err @ dense + penalty * self.d, err.sum()
            gw, gd, gb = gw + g * g, gd + h * h, gb + e * e
            self.w -= step * g / np.sqrt(gw)
            self.d -= step * h / np.sqrt(gd)
            self.b -= step * e / np.sqrt(gb)
        self.w = self.w.astype(np.float32)

    def _p(self, flat: np.ndarray, whose: np.ndarray, dense: np.ndarray, n: int) -> np.ndarray:
        z = np.bincount(whose, weights=self.w[flat], minlength=n) * SCALE + dense @ self.d + self.b
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, texts: list[str]) -> np.ndarray:
        flat, whose, dense = hashed(texts)
        return self._p(flat, whose, dense, len(texts))


def unseen(host: Column, share: int = 5) -> Column:
    """Whether a host belongs to the fifth that training doesn't see. Hosts are told apart without case and spaces."""
    return F.pmod(F.xxhash64(F.lower(F.trim(host))), F.lit(share)) == 0


def distinct_parts(df: DataFrame, text: str, host: str, families: list[str] | None = None) -> DataFrame:
    """part, n, seen and kept of the distinct parts of all texts; parts that differ in digits alone are one. n is how
    often a part occurs, seen whether a host of the training set has it, kept whether an unseen host does; with families
    also label, as weak_label gives it, worked out once for each part and before the shuffle."""
    each = df.select(F.coalesce(unseen(F.col(host)), F.lit(False)).alias("away"), F.explode(parts_column(F.col(text))).alias("part"))
    label = [weak_label(F.col("part"), families).alias("label")] if families else []
    each = each.select("away", "part", F.regexp_replace("part", r"\d", "0").alias("shape"), *label)
    rows = each.groupBy("shape").agg(F.min("part").alias("part"), F.count(F.lit(1)).alias("n"), F.bool_or(~F.col("away")).alias("seen"), F.bool_or("away").alias("kept"), *([F.min("label").alias("label")] if families else []))
    return rows.drop("shape")


def sample(labelled: DataFrame, most: int) -> list[tuple[str, int, int]]:
    """part, label, n of at most `most` parts of each label, those with the least hash, on the driver. One job: the
    labels' branches share the shuffled parts."""
    branches = [labelled.where(F.col("label") == label).orderBy(F.xxhash64("part"), "part").limit(most).select("part", "label", "n") for label in (0, 1, 2)]
    got = branches[0].unionByName(branches[1]).unionByName(branches[2]).withColumn("h", F.xxhash64(F.lit("mix"), "part")).collect()
    return [(r.part, r.label, r.n) for r in sorted(got, key=lambda r: (r.h, r.part))]


def fitted(rows: list[tuple[str, int, int]]) -> Linear:
    """A model of labelled parts. Residue is also shown before and after a description, as it may be a part of a text."""
    normal, odd = [t for t, y, _ in rows if y == 0], [(t, n) for t, y, n in rows if y == 1]
    pairs = list(zip(odd, normal * (len(odd) // max(len(normal), 1) + 1)))
    mixed = [(text, 1, n) for (o, n), p in pairs for text in (f"{o} {p}", f"{p} {o}")]
    return Linear(*map(list, zip(*rows, *mixed)))


def train(df: DataFrame, text: str, host: str, most: int = 12_000) -> Linear:
    """A model of the weak labels, fitted on the driver to at most `most` distinct parts of each label from four fifths
    of the hosts. Without residue there is nothing to learn, and the model finds nothing."""
    return fitted(sample(distinct_parts(df, text, host, list(FAMILIES)).where("seen"), most))


def residue(df: DataFrame, row_id: str, text: str, model: Linear, keep: list[str] | None = None) -> DataFrame:
    """row_id (and columns `keep`) with score, the highest probability of a part of the text to be residue, and is_residue.

    A row is residue if it is likelier than not for one of its parts (sentences and lines; not the line TEXT: of words
    seen on screen). Null and blank texts have score 0. All rows are scored, whole, without a shuffle; the model has a
    fixed size of a megabyte.
    """
    names = list(dict.fromkeys([row_id, *(keep or [])]))
    rows = df.select(*names, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, all_parts, seat = [], [], {}
            for i, t in enumerate(batch.column("__text").to_pylist()):
                for p in parts(t) if t else ():
                    owners.append((i, seat.setdefault(p, len(seat))))
            all_parts = list(seat)
            top = np.zeros(batch.num_rows)
            if all_parts:
                scores = np.concatenate([model.score(all_parts[k : k + 2000]) for k in range(0, len(all_parts), 2000)])
                own = np.array(owners)
                np.maximum.at(top, own[:, 0], scores[own[:, 1]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(top), pa.array(top > 0.5)], [*names, "score", "is_residue"])

    return rows.mapInArrow(run, f"{schema}, score double, is_residue boolean")


def validate(df: DataFrame, text: str, host: str, most: int = 12_000) -> DataFrame:
    """test, label, parts, found (scored above a half) and share, over weakly labelled parts that only unseen hosts have
    and, for each family of phrases, over parts of unseen hosts that only its phrases mark, found by a model trained
    without these phrases and without the parts they mark: texts that no list was written from, as far as the model knows,
    and of which the other lists find none."""
    everything = cut(distinct_parts(df, text, host, list(FAMILIES)))
    held = everything.where("kept").dropna(subset=["label"])
    named = F.when(F.col("label") == 0, "plain").when(F.col("label") == 1, "residue").otherwise("reported")
    counts = [F.count(F.lit(1)).alias("parts"), F.sum(F.col("is_residue").cast("long")).alias("found"), F.avg(F.col("is_residue").cast("double")).alias("share")]
    model = fitted(sample(everything.where("seen"), most))
    out = residue(held.where("not seen"), "part", "part", model, keep=["label"]).groupBy(F.lit("unseen hosts").alias("test"), named.alias("label")).agg(*counts)
    for family in FAMILIES:
        rest = [f for f in FAMILIES if f != family]
        alone = matches(F.col("part"), [family]) & ~matches(F.col("part"), rest)
        others = everything.where("seen").where(~matches(F.col("part"), [family])).withColumn("label", weak_label(F.col("part"), rest))
        without = fitted(sample(cut(others), most))
        left = residue(held.where((F.col("label") == 1) & alone), "part", "part", without)
        out = out.unionByName(left.groupBy(F.lit(f"without {family}").alias("test"), F.lit("residue").alias("label")).agg(*counts))
    return out
