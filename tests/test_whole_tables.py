"""Queries over whole tables, also their dirty rows, equal plain loops."""

import hashlib
import re
from types import SimpleNamespace

from filmstrip.catalog.scalars import caption_parts, label_slots

DIRTY = [None, "", "  ", "\t", "lia sang trái\t", " lia ", "một dòng\n", "a\nb", "\nx", "a\n1. khác", "3 | ba\n2 | hai"]


def slots(raw, n):
    out = [""] * n
    for line in map(str.strip, raw.split("\n")):
        m = re.match(r"^\s*[-*•]?\s*(\d{1,2})\s*[|.):\-]\s*(.+?)\s*$", line)
        if m and 1 <= int(m[1]) <= n and not out[int(m[1]) - 1]:
            out[int(m[1]) - 1] = m[2]
    return out


def test_labels_of_all_events(spark):
    data = [(i * 100 + j, m, a) for i, m in enumerate(DIRTY) for j, a in enumerate(DIRTY)]
    got = {r.id: ([r.slot1, r.slot2, r.slot3], r.raw_md5) for r in label_slots(SimpleNamespace(ev=spark.createDataFrame(data, "id long, motion string, action string"))).collect()}
    want = {}
    for i, m, a in data:
        raw = f"Đây là nhãn:\n2 | {a or ''}\n9 | x\n1. {m or ''}"
        want[i] = (slots(raw, 3), hashlib.md5(raw.encode()).hexdigest())
    assert got == want


def test_all_captions_are_taken_apart(spark):
    data = list(enumerate([*DIRTY, " \n", "\nhai\n", "ba\nTEXT: áo đỏ\n", "bốn\nTEXT: (không có)\n", "\nTEXT: cầu", "năm\t\nTEXT:\nsáu\n"]))
    got = {r.caption_id: (r.said, r.seen) for r in caption_parts(SimpleNamespace(ca=spark.createDataFrame(data, "caption_id long, caption string"))).collect()}
    want = {}
    for i, c in data:
        said, _, seen = (c or "").partition("\nTEXT:")
        want[i] = (None, None) if c is None else (said.strip(), "" if seen.strip() == "(không có)" else seen.strip())
    assert got == want
