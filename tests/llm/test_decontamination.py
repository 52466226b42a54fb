import random

import pytest

from ledgerline.llm import decontamination as d
from ledgerline.llm.queries import QUERIES


def plain_edits(item, text):
    """Fewest edits between the whole item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a != b)))
    return min(row)


def budget(item):
    m = len(item)
    return min(int(d.RATE * m), max(m // d.Q - 1, 0))


def changed(pick, text, n):
    chars = list(text)
    for _ in range(n):
        at = pick.randrange(len(chars))
        chars[at : at + 1] = pick.choice([[], ["x"], [chars[at], "y"]])
    return "".join(chars)


def test_all_texts_within_the_budget_are_found_and_no_others():
    pick = random.Random(4)
    words = "the of ation ing stone marble quiet river umbra lantern".split()

    def prose(n):
        return " ".join(pick.choices(words, k=n)) + " " + pick.choice("abcdefghij")

    items = [(i, prose(pick.randint(3, 14))) for i in range(12)]
    texts = []
    for _ in range(150):
        item = pick.choice(items)[1]
        inside = changed(pick, item, pick.choice([0, 1, budget(item.encode()), budget(item.encode()) + 4]))
        texts.append(pick.choice(["", prose(6) + " "]) + inside + pick.choice(["", " " + prose(5)]))
    texts += [None, "", "   ", items[0][1].upper().replace(" ", "\n\t "), items[1][1][:-1], items[1][1][1:]]
    index = d.index_of(items)
    found = {(t, i): e for t, i, e, _, _ in d.search(texts, index)}
    for t, text in enumerate(texts):
        for i, item in enumerate(index.texts):
            edits = plain_edits(item, d.normal(text or ""))
            if edits <= index.edits[i]:
                assert found.pop((t, i)) == edits
    assert not found


def test_an_item_does_not_run_over_the_border_of_two_texts():
    item = "a passage of some length that stands on the border of texts"
    texts = [item[:30], item[30:], item[:57], item[57:], "x" + item]
    assert {t for t, *_ in d.search(texts, d.index_of([(1, item)]))} == {2, 4}


def test_short_null_and_empty_items():
    index = d.index_of([(1, "short"), (2, "exactly8"), (3, " ")])
    assert index.ids == [2]
    assert [h[:3] for h in d.search(["is exactly8 it", "is exactl8 it"], index)] == [(0, 0, 0)]
    assert d.search(["anything"], d.index_of([])) == []


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_tables(spark, awkward, none, block):
    items = spark.createDataFrame([(7, "alpha beta gamma delta"), (8, None), (None, "tail tail tail tail"), (9, "w5 w6 w7 w8 w9 w10 w11")], "item_id long, text string")
    docs = awkward.unionByName(
        spark.createDataFrame([(900, "so ALPHA  beta\ngamma delta it is")], "doc_id long, text string"), allowMissingColumns=True
    )
    rows = d.find_items(docs, items, block_bytes=block).select("doc_id", "item_id", "n_edits").collect()
    assert {(900, 7, 0), (103, 9, 0)} <= {tuple(r) for r in rows}
    bad = {r.doc_id for r in rows}
    kept = d.without_items(docs, items, block_bytes=block)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, (r.doc_id for r in docs.collect() if r.doc_id not in bad)))
    assert d.find_items(none, items).count() == 0
    assert d.find_items(docs, items.limit(0)).count() == 0


def test_query_against_plain_search(spark, folder):
    found = {(r.doc_id, r.item_id): r.n_edits for r in QUERIES["op3_decontamination"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    normal = [(k, d.normal(t)) for k, t in docs]
    exact = {(k, i) for i, item in items for k, t in normal if d.normal(item) in t}
    assert exact and exact == {k for k, edits in found.items() if edits == 0}
    texts = {k: t for k, t in normal}
    for (k, i), edits in found.items():
        item = d.normal(dict(items)[i])
        if edits:
            assert plain_edits(item, texts[k]) == edits <= budget(item)
