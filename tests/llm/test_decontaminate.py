"""Operator 8 against a brute-force version."""

import hashlib
import re

import pytest
from helpers_llm import docs, odd_rows, prose, same_rows

from larder.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(w[i:i + k])]
        ids = sorted(map(str, found))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def planted():
    item = prose(50, 30)
    items = [(1, item), (10, prose(51, 12)), (2, "Zwei Wörter!"), (3, None), (4, "..."), (5, prose(51, 12)), (6, item.upper())]
    rows = [(i, t) for i, t, *_ in odd_rows()]
    cut = item.split()
    rows += [(20, prose(60, 40) + ", " + item.title() + "! " + prose(61, 40)), (21, " ".join(cut[5:15])), (22, " ".join(cut[5:14])),
             (23, "x zwei\nwörter y zwei, Wörter"), (24, " ".join(cut[:9]) + " other " + " ".join(cut[9:])), (25, prose(51, 12) + " " + item),
             (26, " ".join(cut[:5])), (27, " ".join(cut[5:]))]
    return rows, items


def test_hits_equal_brute_force(spark):
    rows, items = planted()
    df = docs(spark, [(i, t, None, None, None) for i, t in rows])
    found = decontaminate.find_hits(df, spark.createDataFrame(items, ITEMS)).drop("items")
    assert same_rows([tuple(r) for r in found.collect()], brute(rows, items))


def test_blocks_of_windows_give_the_same(spark, monkeypatch):
    rows, items = planted()
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.find_hits(df, spark.createDataFrame(items, ITEMS)).drop("items")
    assert same_rows([tuple(r) for r in found.collect()], brute(rows, items))


@pytest.mark.parametrize("items", [[], [(1, None), (None, "a b")]])
def test_an_empty_test_set_hits_nothing(spark, items):
    found = decontaminate.find_hits(docs(spark), spark.createDataFrame(items, ITEMS)).collect()
    assert len(found) == len(odd_rows()) and not any(r.contaminated for r in found)
    assert decontaminate.find_hits(docs(spark, []), spark.createDataFrame(items, ITEMS)).collect() == []


def test_removing_documents_and_spans(spark):
    rows, items = planted()
    bad = {r[0] for r in brute(rows, items) if r[5]}
    df = docs(spark, [(i, t, None, None, None) for i, t in rows])
    bench = spark.createDataFrame(items, ITEMS)
    kept = decontaminate.remove_contaminated(df, bench)
    assert kept.columns == df.columns
    assert same_rows([r.doc_id for r in kept.collect()], [i for i, _ in rows if i not in bad])
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(df, bench).collect()}
    assert cut[23] == "x  y " and cut[22] == dict(rows)[22] and words(cut[21]) == [] and cut[1] is None
    assert words(cut[20]) == words(prose(60, 40) + " " + prose(61, 40))
