"""SentencePiece BPE through a table of distinct chunks.

A chunk is a run of spaces and the letters after it, up to the next space; the text starts with one
more space, as the model file says. No piece of the model has a letter before a space, so no merge
crosses into the next chunk, and the ids of a text are those of its chunks in their order.

1. Texts are read in blocks of some MB. A block is its list of distinct chunks, and its texts as
   places in that list.
2. The lists are cut by a hash of the chunks and shuffled by bucket, a packed row for each block and
   bucket. A bucket is a part of the table of distinct chunks: its task segments each chunk once,
   whatever the number of its places, and answers every block's row with ids.
3. The answers are shuffled back by block, and every block puts the ids in by position.

A chunk stands at most once in a block's list, so no bucket or block is hot, however frequent a word
is. The number of buckets follows from the bytes of all texts, so that a bucket's table fits in memory.

Lists and places come from two reads of the same files, which Spark cuts alike; nothing but the
lists, the answers and the places is written. A block carries a hash of its list, and a block that
came out otherwise the second time is an error, never a wrong id. Inputs that are more than a read of
files are stored first.

Cases: a null text is an empty one: it has the end id alone, and decodes to an empty text. A text
or chunk of any length is segmented whole, by a heap of merges. A literal U+2581 counts as a space,
as in the library. Characters outside the vocabulary become byte pieces. Repeated rows are encoded
alike. A null key is kept. Columns besides key and text are not looked at. A model that changes
texts before encoding, is not BPE, or has pieces with a space after a letter is refused.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from ledgerline.llm.common import offsets, pieces, stored

SPACE = "▁"
BLOCK_BYTES = 24 << 20  # text of a block, unless one text is longer
BUCKET_BYTES = 6 << 20  # text of all blocks for each bucket; its table holds less than that in letters
MAX_MODEL_BYTES = 64 << 20  # the vocabulary is broadcast
NEVER = float("inf")
UNKNOWN = (NEVER, -1)
SHORT = 64  # letters of a chunk whose best pair is looked for by a plain scan


codecs.register_error("each byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


@dataclass(frozen=True)
class Vocabulary:
    """What segmenting needs of a model file."""

    ranks: dict[str, tuple[float, int]]  # piece, with plain spaces: score negated, id
    names: dict[int, str]  # id: what it decodes to
    bytes: dict[int, int]  # byte: id
    letters: dict[int, int]  # id: byte
    end: int

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """The vocabulary of a model file on the driver."""
        with open(path, "rb") as file:
            raw = file.read()
        if len(raw) > MAX_MODEL_BYTES:
            raise ValueError("the model file is too large to broadcast")
        spec = sentencepiece_model_pb2.ModelProto.FromString(raw)
        rules, kinds = spec.normalizer_spec, spec.SentencePiece.Type
        model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        same = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        known = {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
        if not same or spec.trainer_spec.model_type != spec.trainer_spec.BPE or {p.type for p in spec.pieces} - known or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("this is not a plain BPE model of the kind read here")
        ranks, names, byte_ids = {}, {}, {}
        for i, piece in enumerate(spec.pieces):
            if piece.type == kinds.NORMAL:
                name = piece.piece.replace(SPACE, " ")
                if " " in name.lstrip(" "):
                    raise ValueError(f"piece {piece.piece!r} crosses a space")
                ranks[name], names[i] = (-piece.score, i), name
            elif piece.type == kinds.BYTE:
                byte_ids[int(piece.piece[3:-1], 16)] = i
        if len(byte_ids) < 256 or " " not in ranks:
            raise ValueError("the model has no piece for every byte and for the space")
        return cls(ranks, names, byte_ids, {i: b for b, i in byte_ids.items()}, model.eos_id())

    def segment(self, chunk: str) -> list[int]:
        """The ids of a chunk: neighbours are merged by best score, the leftmost of equal ones first."""
        ids = []
        for part in self._scanned(chunk) if len(chunk) <= SHORT else self._queued(chunk):
            held = self.ranks.get(part)
            ids += [held[1]] if held is not None else [self.bytes[b] for b in part.encode("utf-8")]
        return ids

    def _scanned(self, chunk: str) -> list[str]:
        """Merges by a scan for the best pair."""
        ranks, parts = self.ranks, list(chunk)
        pairs = [ranks.get(a + b, UNKNOWN)[0] for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != NEVER:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], UNKNOWN)[0]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], UNKNOWN)[0]
        return parts

    def _queued(self, chunk: str) -> list[str]:
        """The same merges by a heap of pairs."""
        ranks, parts = self.ranks, list(chunk)
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            held = ranks.get(parts[i] + parts[i + 1])
            if held is not None:
                heap.append((held[0], i, i + 1, parts[i] + parts[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, j, whole = heapq.heappop(heap)
            if not parts[i] or not parts[j] or len(parts[i]) + len(parts[j]) != len(whole):
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = whole, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                held = ranks.get(whole + parts[k])
                if held is not None:
                    heapq.heappush(heap, (held[0], i, k, whole + parts[k]))
            h = before[i]
            if h >= 0:
                held = ranks.get(parts[h] + whole)
                if held is not None:
                    heapq.heappush(heap, (held[0], h, i, parts[h] + whole))
        return [p for p in parts if p]

    def spell(self, ids: list[int]) -> str:
        """The text of ids, with the space that the text starts with; control ids spell nothing.

        Byte pieces that follow each other are read as UTF-8 together, each broken byte as U+FFFD.
        """
        names, letters = self.names, self.letters
        if letters.keys().isdisjoint(ids):
            return "".join([names.get(i, "") for i in ids])
        out, raw = [], bytearray()
        for i in ids:
            if i in letters:
                raw.append(letters[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "each byte"))
                raw.clear()
            out.append(names.get(i, ""))
        out.append(raw.decode("utf-8", "each byte"))
        return "".join(out)


def chunk_places(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks of all texts, the places of each text's chunks among them, end to end, and how many."""
    spaced = pc.binary_join_element_wise(" ", pc.replace_substring(texts, SPACE, " "), "")
    cut = pc.replace_substring_regex(pc.if_else(pc.equal(pc.binary_length(texts), 0), "", spaced), "( +)", SPACE + r"\1")
    lists = pc.split_pattern(cut, SPACE)  # what stands before the first mark is empty
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype("int64")
    flat, chunk = lists.flatten(), np.ones(int(sizes.sum()), bool)
    chunk[np.cumsum(sizes) - sizes] = False
    found = flat.filter(pa.array(chunk)).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype("int32"), sizes - 1


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes."""
    return pack(np.ascontiguousarray(numbers, "int32").view("uint8").reshape(-1, 4).T.tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(unpack(data), "uint8").reshape(4, -1).T.copy().view("int32").ravel()


@dataclass(frozen=True)
class Block:
    number: int
    keys: pa.Array
    sizes: np.ndarray  # chunks of each text
    codes: np.ndarray  # places of the texts' chunks in the list, end to end
    chunks: list[str]

    @property
    def mark(self) -> int:
        """A hash of the list, by which both passes know that they read the same block."""
        return int.from_bytes(hashlib.blake2b(SPACE.join(self.chunks).encode(), digest_size=8).digest(), "little", signed=True)


def blocks_of(batches: Iterable[pa.RecordBatch], most_bytes: int) -> Iterator[Block]:
    """The texts of a partition in blocks, whose numbers are made of the partition's."""

    def block_of(number: int, held: list[pa.RecordBatch]) -> Block:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        chunks, codes, sizes = chunk_places(batch.column("text"))
        return Block(number, batch.column("key"), sizes, codes, chunks.to_pylist())

    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in pieces(batches, "text", most_bytes):
        more = int(np.diff(offsets(batch.column("text"))).sum())
        if held and size + more > most_bytes:
            yield block_of(number, held)
            number, held, size = number + 1, [], 0
        held.append(batch)
        size += more
    if held:
        yield block_of(number, held)


def buckets_of(chunks: list[str], n: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(c.encode()) for c in chunks), "int64", len(chunks)) % n


def asked(docs: DataFrame, n: int) -> DataFrame:
    """(bucket, block, mark, chunks): each block's chunks of each bucket, packed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, BLOCK_BYTES):
            bucket = buckets_of(block.chunks, n)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(n + 1)).tolist()
            places = order.tolist()
            lists = [[block.chunks[i] for i in places[a:b]] for a, b in zip(ends, ends[1:])]
            found = [(b, pack(SPACE.join(own).encode())) for b, own in enumerate(lists) if own]
            columns = [pa.array(c, pa.int64()) for c in ([b for b, _ in found], [block.number] * len(found), [block.mark] * len(found))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([c for _, c in found], pa.binary())], ["bucket", "block", "mark", "chunks"])

    return docs.mapInArrow(run, "bucket long, block long, mark long, chunks binary")


def placed(docs: DataFrame, n: int) -> DataFrame:
    """(block, mark, keys, sizes, codes, buckets): each block's texts as places, and the bucket of each chunk."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, BLOCK_BYTES):
            keys = pa.ListArray.from_arrays(pa.array([0, len(block.keys)], pa.int32()), block.keys)
            packed = [pa.array([pack_numbers(x)]) for x in (block.sizes, block.codes, buckets_of(block.chunks, n))]
            numbers = pa.array([block.number], pa.int64()), pa.array([block.mark], pa.int64())
            yield pa.RecordBatch.from_arrays([*numbers, keys, *packed], ["block", "mark", "keys", "sizes", "codes", "buckets"])

    return docs.mapInArrow(run, f"block long, mark long, keys array<{kind}>, sizes binary, codes binary, buckets binary")


def segmented(lists: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(of, of_mark, bucket, sizes, ids): the ids of each block's chunks of each bucket, packed.

    The rows of a bucket follow each other in one task, which holds the bucket's table of chunks.
    """
    held = lists.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, bucket, table = held.value.segment, None, {}
        for batch in batches:
            sizes, ids = [], []
            for own, chunks in zip(batch.column("bucket").to_pylist(), batch.column("chunks")):
                if own != bucket:
                    bucket, table = own, {}
                found = []
                for chunk in unpack(chunks.as_py()).decode().split(SPACE):
                    one = table.get(chunk)
                    if one is None:
                        one = table[chunk] = np.array(segment(chunk), "int32")
                    found.append(one)
                sizes.append(pack_numbers(np.fromiter(map(len, found), "int32", len(found))))
                ids.append(pack_numbers(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("block", "mark", "bucket")), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())],
                ["of", "of_mark", "bucket", "sizes", "ids"],
            )

    dealt = lists.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "of long, of_mark long, bucket long, sizes binary, ids binary")


def tokens(
    docs: DataFrame, model_path: str, *, key: str = "doc_id", text: str = "text", digests: bool = False, bare: bool = False
) -> DataFrame:
    """Encode each text with an end id, and decode its ids again.

    Returns key, n_tokens (the end id counts), ids (array) and decoded; or with ``digests`` key,
    n_tokens and the SHA-256 of the ids (decimal, joined by one space) and of the decoded text.
    ``bare`` says that ``docs`` only reads and filters files; it is stored otherwise.
    """
    vocabulary = Vocabulary.read(model_path)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows if bare else stored(rows, "chunk-texts")
    n = -(-max(rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0], 1) // BUCKET_BYTES)
    answers = segmented(asked(rows, n), vocabulary)

    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "n_tokens"] + (["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])
    schema = f"key {kind}, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    end = str(vocabulary.end)

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    def table_of(buckets: np.ndarray, found: pa.Table) -> tuple[list[str], list[str]]:
        """Ids as decimal text, and what they spell, of each chunk of a block in its own order."""
        names, spell = [str(i) for i in range(1 + max(max(held.value.names), max(held.value.letters)))], held.value.spell
        ids, spelt = [""] * len(buckets), [""] * len(buckets)
        order = np.argsort(buckets, kind="stable")
        starts = dict(zip(*np.unique(buckets[order], return_index=True)))
        for bucket, sizes, packed in zip(*(found.column(c).to_pylist() for c in ("bucket", "sizes", "ids"))):
            all_ids, at = unpack_numbers(packed).tolist(), 0
            sizes = unpack_numbers(sizes).tolist()
            first = starts[bucket]
            for place, size in zip(order[first : first + len(sizes)].tolist(), sizes):
                own = all_ids[at : at + size]
                ids[place], spelt[place] = " ".join([names[i] for i in own]), spell(own)
                at += size
        return ids, spelt

    def put_back(texts: pa.Table, found: pa.Table) -> pa.Table:
        n_tokens, first, second, keys = [], [], [], []
        for row in texts.to_pylist():
            buckets = unpack_numbers(row["buckets"])
            if len(buckets) and not found.num_rows:
                raise RuntimeError("a block of texts changed between two reads: the input is more than a read of files")
            ids, spelt = table_of(buckets, found)
            codes, at = unpack_numbers(row["codes"]), 0
            keys += row["keys"]
            for size in unpack_numbers(row["sizes"]).tolist():
                places = codes[at : at + size].tolist()
                at += size
                all_ids = " ".join([*map(ids.__getitem__, places), end])
                decoded = "".join(map(spelt.__getitem__, places))[1:]
                n_tokens.append(all_ids.count(" ") + 1)
                first.append(sha(all_ids) if digests else [int(i) for i in all_ids.split(" ")])
                second.append(sha(decoded) if digests else decoded)
        kinds = texts.schema.field("keys").type.value_type, pa.int64(), pa.string() if digests else pa.list_(pa.int32()), pa.string()
        return pa.table([pa.array(c, t) for c, t in zip((keys, n_tokens, first, second), kinds)], names)

    both = placed(rows, n).groupBy("block", "mark").cogroup(answers.groupBy("of", "of_mark")).applyInArrow(put_back, schema)
    return both.withColumnRenamed("key", key)
