import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import bpe
from ledgerline.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(open(PATH, encoding="utf-8").read())


def test_random_texts(library, encoder):
    pick = random.Random(2)
    pool = list("aaabbeiothnrsΣİßéñ'!.,$ \n\t\u00a00123<|>東😀") + ["<|startoftext|>", "<|endoftext|>", "the", "ing", "'s", "'RE", "e\u0301", "aaaaaaaa"]
    for _ in range(4000):
        text = "".join(pick.choices(pool, k=pick.randint(0, 25)))
        ids = encoder.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_one_long_word(library, encoder):
    for text in ("ab" * 5000, "a" * 7001, "étéé" * 900):
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_the_cache_may_turn_over(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    small = bpe.Encoder(open(PATH, encoding="utf-8").read())
    text = "one two three four five six one two three seven eight nine one"
    assert small.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_awkward_rows(awkward, none, library):
    found = sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in bpe.tokens(awkward, PATH).collect()), key=str)
    want = []
    for k, t in awkward.select("doc_id", "text").collect():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((k, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    assert found == sorted(want, key=str)
    assert bpe.tokens(none, PATH).count() == 0


def test_query_against_the_library(spark, folder, library):
    found = {r.doc_id: r for r in QUERIES["op4_bpe"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for k, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        assert [found[k].n_tokens, found[k].ids_sha256, found[k].decoded_sha256] == [len(ids), *digests]


def test_ascii_and_white_space_as_the_library_cuts_them(library, encoder):
    signs = [chr(c) for c in range(128)] + list("\x85\xa0\u2003\u2028\u202f\u3000\u200b\ufeff\u00c0\u0663")
    for a in signs:
        for b in ["s", "'", "7", " ", "\x1f", "é"]:
            text = f"it{a}{b}{a}ll {a}{a}\t{b}'re"
            assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_patterns_keep_the_white_space_step(encoder):
    spec = json.loads(open(PATH, encoding="utf-8").read())
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    split["pattern"]["Regex"] = r" ?\p{L}+| "
    other, library = bpe.Encoder(json.dumps(spec)), Tokenizer.from_str(json.dumps(spec))
    for text in ("a\t\tb  c", "Été\u3000 l\u00e0", " x \n"):
        assert other.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_pieces_on_both_sides_of_the_longest_cached_one(library, encoder):
    pick = random.Random(5)
    for n in range(bpe.LONG - 2, bpe.LONG + 3):
        for pool in ("a", "ab", "etaoinshr", "é東", "😀👍"):
            text = "".join(pick.choices(pool, k=n))
            assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_what_is_known_of_a_prefix_serves_other_pieces(library, monkeypatch):
    fresh, asked = bpe.Encoder(open(PATH, encoding="utf-8").read()), []
    plain = fresh.compatible
    monkeypatch.setattr(fresh, "compatible", lambda left, right: asked.append(left) or plain(left, right))
    pick = random.Random(4)
    ends = ["".join(pick.choices("etaoinshrdlu", k=3)) for _ in range(200)]
    text = " ".join(f"undertheingbleationmentouchstrand{end}" for end in ends)
    assert fresh.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(asked) < 10 * len(ends)  # letters of a word: 36
