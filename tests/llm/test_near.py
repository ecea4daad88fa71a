import collections
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__
from dwellrank.llm import jaccard_join as jj
from dwellrank.llm.components import components
from tests.llm.conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def closed(ids, linked):
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows):
    """doc_id to (set size, component) by comparing every pair that shares a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    pairs = {(a, b) for ids in where.values() for k, a in enumerate(ids) for b in ids[k + 1 :]}
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    label = closed(sets, linked)
    return {i: (len(s), label[i]) for i, s in sets.items()}


def found(spark, folder):
    rows = __spark_entry__.queries()["op6_jaccard_regions"](spark, folder).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_op6_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert found(spark, folder) == brute(rows)


@pytest.fixture
def hard_rows():
    """Copies, chains of near copies, and documents made of common passages around the threshold."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, text = [], lambda n: [word() for _ in range(n)]
    base, passage, other = text(120), text(60), text(40)
    for _ in range(70):  # near copies of one text, most within reach of each other, some not
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(len(copy))] = word()
        rows.append(" ".join(copy))
    for _ in range(60):  # one passage in all of them, at every share of the text
        rows.append(" ".join(text(rng.randint(0, 40)) + passage + text(rng.randint(0, 20))))
    for _ in range(45):
        rows.append(" ".join(passage + other + text(rng.randint(0, 12))))
    chain = text(100)
    for k in range(40):  # each is close to the next only
        chain = chain[2:] + text(2)
        rows.append(" ".join(chain).title())
    rows += ["one two three", "ONE  two\nthree", "one two three four", "one two three four five"] * 20
    return list(enumerate(rows, 1000))


def test_op6_on_hot_groups_and_chains(spark, as_table, hard_rows, monkeypatch):
    monkeypatch.setattr(jj, "HOT", 8)
    monkeypatch.setattr(jj, "PIVOTS", 3)
    monkeypatch.setattr(jj, "LEAF", 12)
    monkeypatch.setattr(jj, "CHUNK", 20)
    assert found(spark, as_table(hard_rows)) == brute(hard_rows)


def test_op6_takes_awkward_texts(spark, as_table):
    rows = __spark_entry__.queries()["op6_jaccard_regions"](spark, as_table(AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r.doc_id: r for r in rows}
    assert [(by_id[i].n_shingles, by_id[i].component_id) for i in (1, 2, 3, 4, 8, 9)] == [
        (0, 1), (0, 2), (0, 3), (1, 4), (3, 8), (3, 8),
    ]
    assert by_id[None].component_id is None and by_id[6].n_shingles == 1


def test_op6_on_an_empty_table(spark, as_table):
    assert found(spark, as_table([])) == {}


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(1, 400), st.data())
def test_close_sets_share_a_ranked_prefix(a, b, data):
    a, b = min(a, b), max(a, b)
    least = -(-4 * (a + b) // 9)
    if least > a:
        return
    rng = np.random.default_rng(data.draw(st.integers(0, 2**32)))
    pool = np.unique(rng.integers(0, 2**64, a + b + 50, np.uint64))
    rng.shuffle(pool)
    common = data.draw(st.integers(least, a))
    x, y = np.sort(pool[:a]), np.sort(np.concatenate([pool[:common], pool[a : a + b - common]]))
    hot = set(pool[rng.random(len(pool)) < rng.random()].tolist())
    counted = data.draw(st.sampled_from([jj.PART, jj.ALL]))
    prefixes = []
    for s in (x, y):
        inside = jj.rankable_part(s, counted)
        marks = np.array([v in hot for v in inside.tolist()], bool)
        prefixes.append(jj.ranked_prefix(inside, marks, jj.prefix_length(len(s)), counted)[0])
    small = set(prefixes[0][: jj.index_length(a)].tolist())
    assert small & set(prefixes[1].tolist())
    plain = [{v for v in p.tolist() if v not in hot} for p in prefixes]
    need = jj.least_shared(a, b, *[len(p) - len(q) for p, q in zip(prefixes, plain)])
    assert len(plain[0] & plain[1]) >= need


def test_components_of_random_links(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1080)]
    nodes = {x for pair in links for x in pair if pair[0] != pair[1]}
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in rows} == closed(nodes, [p for p in links if p[0] != p[1]])
    assert len(rows) == len(nodes)


def all_links(rows):
    """Every linked pair of ids, by comparing all of them."""
    sets = [(i, shingles(t)) for i, t in rows]
    return {(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if x and 100 * len(x & y) >= 80 * len(x | y)}


@pytest.mark.parametrize("block", [jj.BLOCK, 5])
def test_op6_counts_every_link(spark, as_table, hard_rows, monkeypatch, block):
    monkeypatch.setattr(jj, "HOT", 8)
    monkeypatch.setattr(jj, "PIVOTS", 3)
    monkeypatch.setattr(jj, "LEAF", 12)
    monkeypatch.setattr(jj, "CHUNK", 20)
    monkeypatch.setattr(jj, "BLOCK", block)
    monkeypatch.setattr(jj, "COLUMNS", 64)
    expected = collections.Counter(x for pair in all_links(hard_rows) for x in pair)
    rows = __spark_entry__.queries()["op6_jaccard_regions"](spark, as_table(hard_rows)).collect()
    assert {r.doc_id: r.n_links for r in rows} == {i: expected[i] for i, _ in hard_rows}


def test_all_links_between_distinct_sets(spark, hard_rows):
    docs = spark.createDataFrame(hard_rows, "doc_id long, text string")
    links, nodes = jj.near_duplicate_links(docs)
    node = {r.doc_id: r.node for r in nodes.collect()}
    expected = {tuple(sorted((node[a], node[b]))) for a, b in all_links(hard_rows) if node[a] != node[b]}
    found = [(r.a, r.b) for r in links.collect()]
    assert len(found) == len(set(found)) and set(found) == expected
