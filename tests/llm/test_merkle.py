import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle
from ledgerline.llm.queries import QUERIES

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESULT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """The root, and for every leaf its steps (sibling or nothing, whether it stands left)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for path, i in zip(paths, at):
            path.append((level[i ^ 1] if i ^ 1 < len(level) else "", i & 1))
        level = [H("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def plain(rows):
    """rows of FIELDS -> rows of the manifest."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    own = {v: sorted((r for r in rows if r[2] == v), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for v in langs}
    trees = {v: tree([leaf(r) for r in own[v]]) for v in langs}
    root, tops = tree([trees[v][0] for v in langs])
    out = []
    for lang, top in zip(langs, tops):
        subroot, paths = trees[lang]
        for row, path in zip(own[lang], paths):
            path, claimed = path + top, list(row)
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                claimed[3] += 1
            cur = leaf(claimed)
            for other, left in path:
                cur = H(other + cur if left else cur + other)
            out.append((row[0], leaf(row), subroot, root, H("".join(o for o, _ in path)), cur, cur == root))
    return sorted(out, key=str)


def found(docs, **options):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    claimed = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return sorted(map(tuple, merkle.manifest(docs, FIELDS, claimed=claimed, **options).select(*RESULT).collect()), key=str)


def test_layout_is_the_recursive_one():
    def laid_out(depth, index, levels):
        if levels == 1:
            return [(depth, index)]
        upper = levels // 2
        out = laid_out(depth, index, upper)
        for i in range(1 << upper):
            out += laid_out(depth + upper, (index << upper) + i, levels - upper)
        return out

    for levels in range(1, 10):
        want = {node: place for place, node in enumerate(laid_out(0, 0, levels))}
        got = {(d, i): p for d in range(levels) for i, p in enumerate(merkle.address(d, np.arange(1 << d), levels).tolist())}
        assert got == want


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 11, 16])
def test_a_block_gives_the_plain_tree(count):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(count)]
    height = max(count - 1, 0).bit_length()
    root, paths = tree([x.hex() for x in leaves])
    nodes = merkle.built(leaves, height)
    assert merkle.node(nodes, 0).hex() == root
    for start, path, want in zip(leaves, merkle.block_paths(nodes, count, height), paths):
        assert merkle.siblings(path).decode() == "".join(o for o, _ in want)
        assert merkle.folded(start, path).hex() == root
        assert len(path) < merkle.STEP or merkle.folded(leaves[0] + b"x", path).hex() != root


@pytest.mark.parametrize(("seed", "height", "langs"), [(1, 1, 3), (2, 2, 9), (3, 3, 1), (4, 11, 5)])
def test_against_plain_trees(spark, seed, height, langs):
    pick = random.Random(seed)
    names = [None, "en", "de", "é", "zz", "", "EN", "fr", "东"][:langs]
    rows = [(i * 3 - 50, pick.choice(["a", None]), pick.choice(names[: 1 + i % langs]), pick.choice([None, i]), "x" * (i % 5)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    got = found(docs, height=height)
    assert got == plain(rows)
    assert {r[-1] for r in got} == {True, False}


def test_awkward_rows(spark, awkward, none):
    kind = "doc_id", "'s' AS source", "IF(doc_id > 20, NULL, 'x') AS lang", "length(text)::long AS n_chars", "text", "key", "1 AS tree", "2 AS path", "3 AS hash", "4 AS grp", "5 AS place"
    docs = awkward.selectExpr(*kind)
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    assert found(docs, height=2) == plain(rows)
    assert found(none.selectExpr(*kind)) == []
    one = docs.filter("doc_id = 104")
    assert found(one) == plain([tuple(r) for r in one.select(*FIELDS).collect()])


def test_query_against_plain_trees(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*FIELDS).collect()]
    got = QUERIES["op13_merkle"](spark, folder).select(*RESULT).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)
