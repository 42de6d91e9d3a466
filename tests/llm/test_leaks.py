import random
import unicodedata

import pytest

from filmstrip.llm.leaks import leaks, shared_stretch

Q1 = "Cảnh này quay đối diện cổng vườn chè: một người phụ nữ vai vác túi vải băng qua đường bằng hai tay. Ở góc phải là tấm phông màu xanh rêu bị che một nửa còn ba tài xế cổ đeo còi lau thùng hàng."
Q2 = "The wanted clip opens on a striped umbrella off to one side. A sun burnt dancer very carefully leans on the wall; a moment later another bearded guard about three times pulls an iron gate."


def run(spark, docs, queries=(("q1", Q1), ("q2", Q2), ("q0", None), ("qs", "too short a query")), kind="words"):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, query_id string")
    q = spark.createDataFrame(list(queries), "query_id string, query string")
    return sorted((r.doc_id, r.query_id) for r in leaks(d, q, "doc_id", "text", "query_id", "query").collect() if r.kind == kind)


def marked(words):
    return "\n".join(f"00:{10 + i:02d} " + " ".join(words[7 * i : 7 * i + 7]) for i in range(len(words) // 7 + 1))


def cases():
    w1, w2 = Q1.split(), Q2.split()
    plain = "".join(c for c in unicodedata.normalize("NFKD", Q1) if not unicodedata.combining(c)).replace("đ", "d")
    put_in = " ".join(x for i, w in enumerate(w1) for x in ([w, "nhé"] if i % 8 == 7 else [w]))
    swapped = " ".join("kia" if i % 8 == 5 else w for i, w in enumerate(w1))
    other = " ".join("kia" if i % 4 == 3 else w for i, w in enumerate(w1))
    return [
        (1, "xin chào " + Q1 + " hết", "q1"), (2, Q2.upper(), "q2"), (3, unicodedata.normalize("NFD", Q1), "q1"), (4, plain, "q1"), (5, marked(w1), "q1"), (6, put_in, "q1"), (7, swapped, "q1"),
        (8, " ".join(w2[5:25]), "q2"), (9, " ".join(w2[5:24]), None), (10, other, None), (11, " ".join(reversed(w1)), None), (12, "", None), (13, None, None), (14, "a " * 30000 + Q2, "q2"),
        (15, " ".join(w1[:12]) + " khác hẳn đoạn kia rồi nhé bạn " + " ".join(w1[12:24]), None),
    ]


@pytest.mark.parametrize("rows", ["20000", "10"])
def test_cases_by_broadcast_and_by_join(spark, rows):
    spark.conf.set("filmstrip.broadcastRows", rows)
    try:
        got = run(spark, [(i, t) for i, t, _ in cases()])
    finally:
        spark.conf.unset("filmstrip.broadcastRows")
    assert got == sorted((i, q) for i, _, q in cases() if q)


def test_other_values_in_the_slots_are_another_text(spark):
    """The same template with other numbers, names and things is no case as soon as too many words differ."""
    words = Q2.split()
    changed = " ".join({"striped": "white", "umbrella": "fence", "dancer": "farmer", "sun": "pale", "burnt": "eyed", "three": "five", "iron": "old", "gate": "door", "bearded": "tall", "guard": "clerk"}.get(w.strip(".;"), w) for w in words)
    assert run(spark, [(1, changed)]) == []


Q3 = "In the report 12 boats left Port Arden at 7 in the morning and 12 crews from Tile Cape rowed 40 km north while Mira Holt counted 7 flags of Port Arden on the pier"


@pytest.mark.parametrize("rows", ["20000", "10"])
def test_reparameterised_queries_are_found_if_their_slots_are_consistent(spark, rows):
    def filled(boats, hour, crews, km, flags, port="Port Arden", other=None):
        return Q3.replace("12 boats", f"{boats} boats").replace("at 7", f"at {hour}").replace("12 crews", f"{crews} crews").replace("40 km", f"{km} km").replace("7 flags", f"{flags} flags").replace("Port Arden on", f"{other or port} on").replace("left Port Arden", f"left {port}").replace("Tile Cape", "Old Salt Bay").replace("Mira Holt", "Jon Ray Vell")

    docs = [(1, Q3), (2, filled(30, 9, 30, 88, 9, "Lund")), (3, filled(30, 9, 31, 88, 8, "Lund", "Vik")), (4, filled("ba mươi", "chín", "ba mươi", 5, "chín")), (5, "In the report of Lund 9 boats left at noon")]
    spark.conf.set("filmstrip.broadcastRows", rows)
    try:
        assert run(spark, docs, (("q3", Q3),)) == [(1, "q3")]
        assert run(spark, docs, (("q3", Q3),), "template") == [(2, "q3"), (3, "q3"), (4, "q3")]
        digits = [(1, " ".join(f"w{i} {i}" if i % 4 else f"w{i} {i + 50}" for i in range(1, 15))), (2, " ".join(f"w{i} {7 if i % 2 else 8}" for i in range(1, 15)))]
        same = (("q", " ".join(f"w{i} 5" for i in range(1, 15))),)
        assert run(spark, digits, same, "template") == []  # one number can't be many
    finally:
        spark.conf.unset("filmstrip.broadcastRows")


def test_both_ways_give_the_same_rows(spark):
    base = "/root/testdata/sf0.01"
    d, q = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/kis_queries.parquet")
    found = []
    for rows in ("20000", "10"):
        spark.conf.set("filmstrip.broadcastRows", rows)
        found.append(sorted(map(tuple, leaks(d, q, "doc_id", "text", "query_id", "query").collect())))
        spark.conf.unset("filmstrip.broadcastRows")
    assert found[0] == found[1] and len(found[0]) >= 34


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, Q1)], [("q", None)]) == []


def brute(q, d, least, per):
    """Whether a stretch that begins and ends with equal words exists, by the fewest edits of every alignment."""
    for i in range(len(q) - least + 1):
        edits = [0 if w == q[i] else 99 for w in d]
        for j in range(i + 1, len(q)):
            best, nxt = 99, [99] * len(d)
            for k in range(1, len(d)):
                best = min(best + 1, edits[k - 1])
                nxt[k] = best + (d[k] != q[j])
            edits = nxt
            if j - i + 1 >= least and min((e for e, w in zip(edits, d) if w == q[j]), default=99) * per <= j - i + 1:
                return True
    return False


def test_stretch_against_all_alignments():
    rng = random.Random(4)
    seen = set()
    for _ in range(300):
        q = [rng.randrange(1, 40) for _ in range(30)]
        part = q[(a := rng.randrange(6)) : a + rng.randrange(16, 26)]
        d = [rng.randrange(50, 60) for _ in range(5)]
        for w in part:
            x = rng.random()
            d += [99, w] if x < 0.05 else [98] if x < 0.1 else [w]
        d += [rng.randrange(50, 60) for _ in range(5)]
        want = brute(q, d, 20, 7)
        seen.add(want)
        assert shared_stretch(q, d, 5 - a, 20, 7) == want
    assert seen == {True, False}


@pytest.mark.parametrize("rows", ["20000", "0"])
def test_edits_that_leave_one_run_of_five_or_six(spark, rows):
    own = [a + b for a in "bcdgh" for b in "aeiou"][:21]
    docs = []
    for i, lengths in enumerate(((4, 4, 4, 6), (4, 4, 5, 5), (6, 4, 4, 4), (4, 6, 4, 4))):
        doc, at = list(own), 0
        for n in lengths[:-1]:
            doc[at + n] = "xx"
            at += n + 1
        docs.append((i, "trước đó " + " ".join(doc) + " sau đó"))
    docs.append((9, " ".join(own[:3] + ["xx"] + own[4:7] + ["xx"] + own[8:13] + ["xx"] + own[14:17] + ["xx"] + own[18:])))
    spark.conf.set("filmstrip.broadcastRows", rows)
    try:
        got = leaks(spark.createDataFrame(docs, "id long, t string"), spark.createDataFrame([("q", " ".join(own))], "q string, t string"), "id", "t", "q", "t").collect()
    finally:
        spark.conf.unset("filmstrip.broadcastRows")
    assert {(r.doc_id, r.query_id) for r in got} == {(i, "q") for i in range(4)}
