"""Merkle manifest against a plain tree, over odd rows, many leaves in a group and many groups."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lumenframe.llm import merkle, places
from lumenframe.llm.queries import ORACLE, QUERIES
from tests.compare import differences

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, pos long, digest string, block int, name string, _part int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def plain_tree(nodes):
    """The root, and for each node the siblings of its path and what a changed node leads to."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for i, p in enumerate(at):
            paths[i].append((runs[p // 8], p % 8))
        level, at = [H(*run) for run in runs], [p // 8 for p in at]
    return level[0], paths


def plain_fold(node, path):
    for run, place in path:
        node = H(*run[:place], node, *run[place + 1 :])
    return node


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of rows (doc_id, text, lang, source, n_chars, copy)."""
    groups = {}
    for doc_id, text, lang, source, n_chars, copy in rows:
        leaf = plain_leaf(doc_id, source, lang, n_chars, text)
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, plain_leaf(doc_id, source, lang, n_chars, copy)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])]) for g in names}
    root, tops = plain_tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops, strict=True):
        for (known, doc_id, leaf, copy), path in zip(sorted(groups[g]), trees[g][1], strict=True):
            whole = path + top
            siblings = [d for run, place in whole for k, d in enumerate(run) if k != place]
            out.append((doc_id if known else None, leaf, trees[g][0], root, H(*siblings), plain_fold(copy, whole)))
    return out


def got(docs, copy):
    rows = merkle.manifest(docs, copy)
    folded = merkle.fold(F.col("copy_leaf"), F.col("places"), F.col("siblings"))
    hexed = [merkle.hex_text(F.col(c)) for c in ("leaf", "subroot", "root")]
    rows = rows.select("doc_id", *hexed, F.sha2(merkle.hex_text(F.col("siblings")), 256), folded)
    return Counter(map(tuple, rows.collect()))


def odd():
    rows = [(i, f"text {i}", "en", "src", 6) for i in range(4096 + 700)]  # more than a block
    rows += [(i, f"X{i}", "de", None, None) for i in range(64)] + [(i, None, "fr", "é", 1) for i in range(8)] + [(5, "", "es", "", 0)]
    rows += [(None, None, None, None, None), (None, "a", None, "b", 3), (7, "same", "it", "x", 1), (7, "same", "it", "x", 1), (7, "Other", "it", "x", 1)]
    rows += [(3, "long " * 50_000, "", "x", 1), (9, "漢字 Ünï", "日本", "x", -5)]
    return rows + [(i, "t", f"lang{i}", "s", 1) for i in range(20)]


def test_manifest(spark):
    rows = odd()
    docs = spark.createDataFrame([(*r, "g", 9, "d", 1, "n", 2) for r in rows], SCHEMA).repartition(5)
    # what is checked differs for each document with an X or an O in it
    wanted = plain([(*r, r[1] and r[1].replace("X", "x").replace("O", "o")) for r in rows])
    found = got(docs, F.translate("text", "XO", "xo"))
    assert found == Counter(wanted)
    assert sum(w[5] != w[3] for w in wanted) == 65


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 513])
def test_sizes(spark, n):
    rows = [(i, f"t{i}", "en", "s", 1) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(docs, F.col("text")) == Counter(plain([(*r, r[1]) for r in rows]))


@pytest.mark.parametrize("n", [4095, 4096, 4097, 8192, 8193])
def test_blocks_follow_one_another(n):
    """Roots of blocks, appended again, give the root of the whole tree."""
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    tops = []
    for at in range(0, n, merkle.BLOCK_LEAVES):
        block = merkle.Appender()
        for leaf in leaves[at : at + merkle.BLOCK_LEAVES]:
            block.append(leaf)
        tops.append(block.finish(alone=at == 0 and n < merkle.BLOCK_LEAVES))
    upper = merkle.Appender()
    for top in tops:
        upper.append(top)
    root = upper.finish(alone=True)
    assert root.hex() == plain_tree([x.hex() for x in leaves])[0]


def test_places(spark):
    given = [(k, v) for k in ["a", "b", None, "c"] for v in range({"a": 300, "b": 3}.get(k, 1))]
    rows = spark.createDataFrame([(k, v, 1) for k, v in given], "k string, v int, _local int").repartition(7)
    out = places.placed(rows.drop("_local"), ["k"], ["v"])
    assert Counter(map(tuple, out.collect())) == Counter((k, v, v) for k, v in given)


def test_empty_and_query(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(docs, F.col("text")).count() == 0
    assert differences(spark, SF_DIR, QUERIES["op13_merkle_manifest"], ORACLE["op13_merkle_manifest"]) is None
