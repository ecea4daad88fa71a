import collections
import random
import re

import pytest

import __spark_entry__
from dwellrank.llm import decontamination as dc
from tests.llm.conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return []
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)]


def brute(docs, items):
    """(doc, item) to the best similarity of a window, over all windows that share a shingle."""
    found = {}
    listed = {i: shingles(t) for i, t in items}
    where = collections.defaultdict(set)
    for i, s in listed.items():
        for x in s:
            where[x].add(i)
    for d, text in docs:
        s = shingles(text)
        for i in {i for x in s for i in where.get(x, ())}:
            n = len(listed[i])
            item = collections.Counter(listed[i])
            for at in range(max(1, len(s) - n + 1)):
                window = collections.Counter(s[at : at + n])
                common = sum((window & item).values())
                similarity = common / (n + sum(window.values()) - common)
                if similarity >= 0.8 - 1e-12:
                    found[d, i] = max(found.get((d, i), 0), similarity)
    return found


def as_pairs(rows):
    return {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in rows}


def test_op1_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    read = lambda n, k: [(r[k], r.text) for r in spark.read.parquet(f"{folder}/{n}.parquet").collect()]
    expected = brute(read("documents", "doc_id"), read("benchmark", "item_id"))
    rows = __spark_entry__.queries()["op1_simhash_windows"](spark, folder).collect()
    assert len(rows) == len(expected) > 10 and as_pairs(rows) == expected


def test_edited_cut_repeated_and_short_passages(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(text(n))) for i, n in enumerate([5, 6, 12, 30, 60, 60])]
    items += [(6, "yes"), (7, "one two three four"), (8, None), (9, ""), (10, "la " * 30), (11, items[3][1])]
    docs = []
    for i, t in items[:6]:
        words = t.split()
        for edits in range(0, 4):
            changed = list(words)
            for _ in range(edits):
                changed[rng.randrange(len(changed))] = word()
            docs.append(" ".join(text(20) + changed + text(20)))
            docs.append(" ".join(changed).upper() + "\n")
        docs.append(" ".join(text(10) + words[: int(len(words) * 0.9)]))
        docs.append(" ".join(words[len(words) // 8 :] + text(10)))
    docs += ["yes", "YES ", "oh yes", "one two  three four", "one two three four five", "la " * 300, "la " * 20, "la la la la"]
    docs = list(enumerate(docs)) + [(100 + k, t) for k, (_, t) in enumerate(AWKWARD)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = dc.find_passages(*frames).collect()
    assert as_pairs(rows) == brute(docs, items)
    for r in rows:
        s = shingles(dict(docs)[r.doc_id])
        assert r.start < len(s)
    clean = dc.clean_documents(frames[0].selectExpr("*", "1 as item_id", "2 as size"), frames[1])
    assert clean.columns == ["doc_id", "text", "item_id", "size"]
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {r.doc_id for r in rows}


def test_empty_tables_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert sorted((r.doc_id or 0) for r in dc.find_passages(docs, items).collect()) == [0, 1]
    assert dc.find_passages(docs.limit(0), items).count() == 0
    assert dc.find_passages(docs, items.limit(0)).count() == 0
    assert dc.clean_documents(docs, items).count() == 1
