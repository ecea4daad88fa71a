import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from acceptance import compare
from dwellrank.llm import manifest as mf
from dwellrank.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import AWKWARD, WIDE


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climbed(digests):
    """Levels of a tree and the (left, right) steps of each leaf."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    proofs = []
    for i in range(len(digests)):
        steps = []
        for level in levels[:-1]:
            run = i // 8 * 8
            steps.append(("".join(level[run:i]), "".join(level[i + 1 : run + 8])))
            i //= 8
        proofs.append(steps)
    return levels[-1][0], proofs


def brute(rows):
    """Rows as (doc_id, source, lang, n_chars, text) to the query's rows, sorted as text."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = climbed([leaf(r) for r in groups[g]])
    if not order:
        return []
    root, upper = climbed([trees[g][0] for g in order])
    out = []
    for g, above in zip(order, upper):
        for row, steps in zip(groups[g], trees[g][1]):
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            fold = leaf((*row[:4], text))
            for left, right in steps + above:
                fold = H(left, fold, right)
            proof = H(*(x for step in steps + above for x in step))
            out.append((row[0], leaf(row), trees[g][0], root, proof, fold, fold == root))
    return sorted(out, key=repr)


def asked(spark, folder):
    found = QUERIES["op12_merkle_manifest"](spark, folder)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 513])
def test_sweeps_of_one_block(n):
    digests = [H(str(i)) for i in range(n)]
    nodes = list(mf.forward_sweep(digests, mf.height(n)))
    root, proofs = climbed(digests)
    assert nodes[-1][2] == root and [x[:2] for x in nodes] == sorted(x[:2] for x in nodes)
    chains = mf.reversed_sweep(nodes, n)
    for chain, proof in zip(chains, proofs):
        _, left, right = mf._expanded([chain])
        assert list(zip(left, right)) == proof


def test_query_equals_brute_force_and_sql(spark, monkeypatch):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*mf.COLUMNS).collect()]
    assert asked(spark, folder) == brute(rows)
    name = "op12_merkle_manifest"
    monkeypatch.setitem(compare.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(compare.ORACLES, name, ORACLES[name])
    assert compare.differences(spark, compare.open_tables(folder), folder, name) is None


def test_awkward_rows_and_small_blocks(spark, as_table, monkeypatch):
    """Null groups and ids, repeated rows, one row in a group, blocks of 8 leaves: several rounds."""
    monkeypatch.setattr(mf, "LEVELS", 1)
    monkeypatch.setattr(mf, "BLOCK", 8)
    langs = [None, "en", "en", "é", "", "en"]
    rows = [(i, t, langs[k % 6], None if k % 4 else "A;B", k) for k, (i, t) in enumerate(AWKWARD)]
    rows += [(100 + k % 150, f"Text {k}", "big", "s", k % 3) for k in range(300)] + [(7, "Copy", "big", "s", 1)] * 20
    folder = as_table(rows, WIDE + ", digest string, pos string, grp string")
    assert asked(spark, folder) == brute([(d, s, lang, n, t) for d, t, lang, s, n in rows])


def test_empty_and_single_tables(spark, as_table):
    docs = spark.createDataFrame([(5, "One Row", "en", None, 7)], WIDE)
    one = mf.verified(mf.manifest(docs)).collect()
    digest = leaf((5, None, "en", 7, "One Row"))
    assert [(r.leaf, r.subroot, r.root, r.proof, r.verified) for r in one] == [(digest, digest, digest, [], True)]
    assert mf.verified(mf.manifest(docs.limit(0))).count() == 0


def test_proofs_find_any_change(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en" if i % 3 else "de", "s", i) for i in range(70)], WIDE)
    rows = mf.verified(mf.manifest(docs, tampered={"n_chars": F.when(F.col("doc_id") == 13, 0).otherwise(F.col("n_chars"))}))
    assert [r.doc_id for r in rows.filter("not verified").collect()] == [13]
    # The root does not depend on the order of the rows.
    assert mf.manifest(docs.orderBy(F.desc("doc_id"))).first().root == rows.first().root
