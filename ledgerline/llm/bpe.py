"""BPE by dynamic programming over prefixes, for word-level BPE with an end-of-word mark.

For every prefix of a piece there is exactly one token that its encoding can end with. A token
that ends there fits when it is compatible with the last token of the prefix before it, that is
when BPE would not merge across the border of the two. Prefixes are looked at from the whole piece
backwards, tokens from the longest to its shorter suffixes, so only prefixes that a token leaves
are worked out; what is known of a prefix holds for all pieces that begin with it, and is kept.
Long pieces take all prefixes in order, with the tokens of each from the suffix links of an
automaton over the vocabulary; their ids follow from the back-pointers of the last tokens.

A text is cut into pieces as the tokenizer file says: special tokens in the raw text stand for
themselves; the rest is put in NFC, white space runs become one space (left out where the pattern
does not look at white space), letters are lower-cased, and each match of the file's pattern is a
piece. A file of another kind is refused.

Cases: a null text is encoded as an empty one, which has no ids. Repeated rows are encoded alike.
A long text or word is encoded whole; the work grows with its length times the longest token.
Columns besides key and text are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import pieces as runs

MAX_MODEL_BYTES = 64 << 20  # the tokenizer file is broadcast
CACHED_PIECES = 60_000  # pieces held per generation of a worker's cache; there are two
LONG = 64  # characters; a longer piece is not cached, and takes all its prefixes in order
RUN_BYTES = 1 << 20
END = "\x00"  # end-of-word mark inside the automaton
# A pattern of which no match holds or looks at white space, and what it is for ASCII in lower case.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORDS = r"[a-z]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\sa-z0-9]+"

NEVER = float("inf")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


class Encoder:
    """Encodes pieces and texts with the vocabulary and merges of one tokenizer file."""

    def __init__(self, model_json: str):
        spec = json.loads(model_json)
        model = spec["model"]
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (steps, level["type"], split["behavior"], split["invert"], model["ignore_merges"]) != (
            ["NFC", "Replace", "Lowercase"], "ByteLevel", "Removed", True, False,
        ):
            raise ValueError("this is not a word-level BPE file of the kind read here")
        self.pattern = self.ascii_pattern = regex.compile(split["pattern"]["Regex"])
        self.space = regex.compile(spec["normalizer"]["normalizers"][1]["pattern"]["Regex"])
        if split["pattern"]["Regex"] == WORDS and self.space.pattern == r"\s+":
            self.ascii_pattern, self.space = re.compile(ASCII_WORDS, re.ASCII), None
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.letters = "".join(byte_letters())
        suffix = model["end_of_word_suffix"]
        self.names = {i: t for t, i in model["vocab"].items()}
        vocab = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = vocab[left], vocab[right]
            self.rank[pair] = rank
            parts.setdefault(vocab[left + right], (rank, *pair))
        self.size: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        spelled: dict[str, int] = {}
        reachable = set(parts) | {vocab[c + e] for c in self.letters for e in ("", suffix) if c + e in vocab}
        for token, name in self.names.items():
            if token in reachable:
                text = name[: -len(suffix)] + END if name.endswith(suffix) and len(name) > len(suffix) else name
                self.size[token] = len(text)
                self.automaton.add_word(text, token)
                spelled[text] = token
        self.automaton.make_automaton()
        # Each end of a token, with the longest token that it ends with; each token's next shorter one.
        self.tails: dict[str, int | None] = {}
        shorter: dict[int, int | None] = {}
        for text in spelled:
            longest = None
            for start in range(len(text) - 1, -1, -1):
                token = spelled.get(text[start:])
                if token is not None:
                    shorter[token], longest = longest, token
                self.tails[text[start:]] = longest
        # What a prefix asks of a token: size, next shorter one, id and name after a space.
        self.about = {t: (n, shorter.get(t), f" {t}", f" {self.names[t]}") for t, n in self.size.items()}
        # A token's outer parts on one side, innermost first, each with the rank of the merge that ends it.
        self.right_edge = {t: self._edge(t, parts, 2) for t in self.size}
        self.left_edge = {t: self._edge(t, parts, 1) for t in self.size}
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int | None, str, str]] = {}
        self.new: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}

    @staticmethod
    def _edge(token: int, parts: dict[int, tuple[int, int, int]], side: int) -> list[tuple[int, float]]:
        edge, ends = [(token, NEVER)], token
        while ends in parts:
            rank, ends = parts[ends][0], parts[ends][side]
            edge.append((ends, rank))
        return edge[::-1]

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE leaves ``left`` and ``right`` side by side.

        The parts that meet at the border are followed in the order of their merges. At equal
        ranks the merge further left comes first.
        """
        held = self.fits.get((left, right))
        if held is not None:
            return held
        xs, ys, i, j, held = self.right_edge[left], self.left_edge[right], 0, 0, True
        while True:
            (x, x_ends), (y, y_ends) = xs[i], ys[j]
            rank = self.rank.get((x, y), NEVER)
            if rank < x_ends and rank <= y_ends and rank is not NEVER:
                held = False
                break
            if x_ends is NEVER and y_ends is NEVER:
                break
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
        if len(self.fits) >= 2 * CACHED_PIECES:
            self.fits.clear()
        self.fits[left, right] = held
        return held

    def spell(self, piece: str) -> str:
        """The letters of a piece's bytes, and the end-of-word mark."""
        if piece.isascii() and piece.isalpha():
            return piece + END
        return piece.encode("utf-8").decode("latin-1").translate(self.letters) + END

    def prefix(self, text: str) -> tuple[int | None, str, str]:
        """The last token of a prefix (None: it cannot be spelled), its ids and token names."""
        tails, known, length, k = self.tails, self.known, len(text), 1
        while k < length and text[-k - 1 :] in tails:
            k += 1
        token = tails.get(text[-k:])
        while token is not None:
            size, shorter, number, name = self.about[token]
            if size == length:
                return token, number, name
            left = text[:-size]
            before = known.get(left)
            if before is None:
                before = self.prefix(left)
                if len(known) >= CACHED_PIECES:
                    known.clear()
                known[left] = before
            last, ids, names = before
            if last is not None:
                fits = self.fits.get((last, token))
                if fits or (fits is None and self.compatible(last, token)):
                    return token, ids + number, names + name
            token = shorter
        return None, "", ""

    def piece_ids(self, piece: str) -> list[int]:
        """The ids of one piece, all its prefixes in order."""
        text = self.spell(piece)
        last: list[int | None] = [None] * (len(text) + 1)
        size, compatible = self.size, self.compatible
        for end, token in self.automaton.iter(text):
            if last[end + 1] is None:
                start = end + 1 - size[token]
                if start == 0 or (last[start] is not None and compatible(last[start], token)):
                    last[end + 1] = token
        ids, at = [], len(text)
        while at:
            token = last[at]
            if token is None:
                raise ValueError(f"the vocabulary cannot spell {piece[:40]!r}")
            ids.append(token)
            at -= size[token]
        return ids[::-1]

    def piece(self, piece: str) -> tuple[str, str]:
        """Ids and token names of a piece, each after a space."""
        found = self.new.get(piece)
        if found is None:
            if len(piece) > LONG:
                ids = self.piece_ids(piece)
                return "".join([self.about[i][2] for i in ids]), "".join([self.about[i][3] for i in ids])
            found = self.old.get(piece)
            if found is None:
                last, ids, names = self.prefix(self.spell(piece))
                if last is None:
                    raise ValueError(f"the vocabulary cannot spell {piece[:40]!r}")
                found = ids, names
            if len(self.new) >= CACHED_PIECES:
                self.old, self.new = self.new, {}
            self.new[piece] = found
        return found

    def text_pieces(self, text: str) -> list[tuple[str, str]]:
        if "<|" not in text:
            return self._plain(text)
        out = []
        for part in self.specials.split(text):
            if part in self.special:
                out.append((f" {self.special[part]}", f" {part}"))
            elif part:
                out += self._plain(part)
        return out

    def _plain(self, text: str) -> list[tuple[str, str]]:
        pattern = self.ascii_pattern
        if not text.isascii():
            pattern = self.pattern
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower-cased without regard to place
        if self.space is not None:
            text = self.space.sub(" ", text)
        new, piece = self.new, self.piece
        return [new.get(p) or piece(p) for p in pattern.findall(text.lower())]

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.text_pieces(text) for i in ids.split()]

    def decode(self, ids: Iterable[int]) -> str:
        """Token names joined by a space: the file names no decoder that would join them closer."""
        special = {i: t for t, i in self.special.items()}
        return " ".join(special[i] if i in special else self.names[i] for i in ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(model_json: str) -> Encoder:
    """The encoder of a file, built once per worker."""
    key = hashlib.sha256(model_json.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model_json)
    return _ENCODERS[key]


def tokens(docs: DataFrame, model_path: str, *, key: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """Encode each text, and decode its ids again.

    Returns key, n_tokens, ids (array) and decoded; or with ``digests`` key, n_tokens and the
    SHA-256 of the ids (decimal, joined by one space) and of the decoded text. No shuffle.
    """
    with open(model_path, encoding="utf-8") as file:
        model_json = file.read()
    if len(model_json) > MAX_MODEL_BYTES:
        raise ValueError("the tokenizer file is too large to broadcast")
    held = docs.sparkSession.sparkContext.broadcast(model_json)
    schema = f"key {docs.schema[key].dataType.simpleString()}, n_tokens long, "
    schema += "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    names = ["key", "n_tokens"] + (["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(held.value)
        for run in runs(batches, "text", RUN_BYTES):
            n, first, second = [], [], []
            for text in run.column("text").to_pylist():
                found = encoder.text_pieces(text)
                ids = "".join([i for i, _ in found])[1:]
                decoded = "".join([d for _, d in found])[1:]
                n.append(ids.count(" ") + 1 if ids else 0)
                first.append(sha(ids) if digests else [int(i) for i in ids.split()])
                second.append(sha(decoded) if digests else decoded)
            kind = pa.string() if digests else pa.list_(pa.int32())
            columns = [run.column("key"), pa.array(n, pa.int64()), pa.array(first, kind), pa.array(second, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(encode, schema).withColumnRenamed("key", key)
