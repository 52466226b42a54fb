import hashlib
import random

from ledgerline.llm import line_dedup


def plain_chunks(rows, mean=4, least=2):
    """rows (key, text), unique -> key: the lines of repeated chunks."""
    cut = []
    for k, t in rows:
        lines = (t or "").split("\n")
        h = [int(hashlib.md5(s.encode()).hexdigest()[:7], 16) for s in lines]
        starts = [0] + [i for i in range(1, len(lines)) if ((h[i - 2] if i >= 2 else 0) * 131 + h[i - 1]) % 1_000_003 % mean == 0]
        cut.append((k, lines, [(a, b) for a, b in zip(starts, [*starts[1:], len(lines)])]))
    seen, out = set(), {}
    for k, lines, parts in sorted(cut, key=lambda c: (c[0] is not None, c[0] or 0)):
        gone = out[k] = set()
        for a, b in parts:
            body = "\n".join(lines[a:b])
            if b - a >= least and body.strip(" \n"):
                if body in seen:
                    gone.update(range(a, b))
                seen.add(body)
    return out


def without(rows, gone):
    """rows (key, text) -> (key, n_lines, n_removed, kept text)."""
    out = []
    for k, t in rows:
        lines = (t or "").split("\n")
        out.append((k, len(lines), len(gone[k]), "\n".join(line for i, line in enumerate(lines) if i not in gone[k])))
    return sorted(out, key=str)


def plain(rows, mean=4, least=2):
    return without(rows, plain_chunks(rows, mean, least))


def test_against_a_plain_version(spark):
    pick = random.Random(8)
    blocks = [[f"line {b} {i}" for i in range(pick.randint(3, 14))] for b in range(5)]
    rows = []
    for k in range(60):
        lines = [f"own {k} {i}" for i in range(pick.randint(0, 4))] + pick.choice(blocks)
        lines += pick.choice([[], ["", "", ""], pick.choice(blocks)])
        rows.append((k, "\n".join(lines)))
    rows += [(None, "\n".join(blocks[0])), (100, None), (101, ""), (102, "\n\n\n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(map(tuple, line_dedup.dedup_lines(df).collect()), key=str)
    assert found == plain(rows)
    assert sum(r[2] for r in found) > 100


def test_an_inserted_line_moves_few_borders(spark):
    body = [f"sentence number {i}" for i in range(200)]
    rows = [(1, "\n".join(body)), (2, "\n".join(["new", *body[:90], "other", *body[90:]]))]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed > 120 for r in found} == {1: False, 2: True}


def test_awkward_rows(awkward, none):
    found = line_dedup.dedup_lines(awkward, keep=("key", "body")).collect()
    assert len(found) == awkward.count() and {(r.key, r.body) for r in found} == {("x", "y")}
    again = {(r.doc_id, r.text) for r in found}
    assert {(3, awkward.filter("doc_id = 3").first().text), (100, ""), (101, "")} <= again
    assert line_dedup.dedup_lines(none).count() == 0


def plain_passages(rows, words=50):
    """rows (key, text), unique -> key: the lines that passages take, by comparing lines and pairs of lines."""
    first, out = {}, {}
    cut = [(k, (t or "").split("\n")) for k, t in sorted(rows)]
    for k, lines in cut:
        for i in range(len(lines)):
            first.setdefault((lines[i],), (k, i))
            first.setdefault(tuple(lines[i : i + 2]), (k, i))
    for k, lines in cut:
        n = [len(line.split()) for line in lines]
        gone = {i for i, line in enumerate(lines) if n[i] > words and first[(line,)] < (k, i)}
        again = [first[tuple(lines[i : i + 2])] < (k, i) for i in range(len(lines) - 1)] + [False]
        start = 0
        for i, more in enumerate(again):
            if not more:
                gone |= set(range(start, i + 1)) if i > start and sum(n[start : i + 1]) > words else set()
                start = i + 1
        out[k] = gone
    return out


def test_passages_are_found_wherever_they_stand(spark):
    pick = random.Random(3)
    blocks = [[f"{' '.join(f'w{b}x{i}x{j}' for j in range(pick.randint(5, 60)))}." for i in range(pick.randint(1, 5))] for b in range(12)]
    rows = []
    for k in range(80):
        lines = [f"own {k} {i}" for i in range(pick.randint(0, 3))] + pick.choice(blocks)[pick.randint(0, 1) :]
        rows.append((k, "\n".join([*lines, f"between {k}", *pick.choice(blocks), *pick.choice([[], [f"end {k}"]])])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain_passages(rows)
    found = {r._key: set(r._removed) for r in line_dedup.repeated_passages(df, "doc_id", "text").collect()}
    assert found == {k: {i + 1 for i in gone} for k, gone in want.items() if gone}
    by_chunks = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(df).collect()}
    both = {r.doc_id: r for r in line_dedup.dedup_lines(df, passage_words=50).collect()}
    assert all(both[k].n_removed >= max(len(want[k]), by_chunks[k]) for k, _ in rows)
    assert sum(r.n_removed for r in both.values()) > 2 * sum(by_chunks.values())
    stay = {line for r in both.values() for line in r.text.split("\n")}
    assert stay >= {line for _, t in rows for line in t.split("\n")}


def test_awkward_rows_with_passages(awkward, none):
    assert line_dedup.dedup_lines(awkward, passage_words=50).count() == awkward.count()
    assert line_dedup.dedup_lines(none, passage_words=50).count() == 0
