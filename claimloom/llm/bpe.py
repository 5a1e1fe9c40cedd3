"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A text is cut at special tokens, then by the pre-tokenizer's pattern; each piece is merged alone. The pieces' adjacent pairs
have ranks (a pair that cannot merge has rank infinity) in a segment tree whose nodes hold the smaller rank of their children,
the left one on a tie. The root names the leftmost pair of lowest rank; merging it updates two leaves at most, each in a
logarithmic number of steps, and ends when the root is infinite. A piece of n bytes thus costs O(n log n), however long. Pieces of
up to ``FLAT`` bytes, which nearly all are, have no tree: the lowest rank is looked for in a plain list, which then costs less.
Workers keep the ids of pieces they have seen, up to ``MEMO_CHARS`` characters of them, since words repeat.

The vocabulary file's path is a parameter; the driver reads it and broadcasts its content, whose size is checked. Any style may
be used here: the pieces need a regular expression with Unicode classes and a stateful merge, so texts go through Arrow.

Defined cases: null text is empty; empty text has no tokens (the digests are those of empty strings); texts of any length are
encoded whole; repeated rows are encoded alike; extra columns are kept by ``encode`` and ``decode``, but one that is named like the
result (``ids``, ``decoded``) gives way to it; null ``ids`` decode to the empty text; an empty table gives an empty result. A
vocabulary file that asks for what is not done here (a normalizer, another pre-tokenizer or its options, dropout, prefixes,
``ignore_merges``, added tokens that strip or match single words) is refused.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from claimloom.llm.common import DOCUMENT, arrow_batches, table
from claimloom.session import spread

#: The published pattern of byte-level pre-tokenization, with Unicode white space spelled out.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Characters of the pieces that a worker remembers, and of one such piece; beyond it the memory starts anew. A piece of the usual
#: six characters takes about 400 bytes with its ids, so this is about 300 MB at most.
MEMO_CHARS, MEMO_PIECE = 4_000_000, 64
#: Bytes of the pieces that are merged without a tree.
FLAT = 64
#: Bytes that a vocabulary file may have to be broadcast.
MOST_BYTES = 64 << 20
SHIFT, NEVER = 32, 1 << 60
PLACE = (1 << SHIFT) - 1


def byte_symbols() -> list[str]:
    """The printable symbol of each byte: bytes that print stand for themselves, the others for code points from 256 on."""
    printing = [b for first, last in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(first), ord(last) + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(printing) else chr(next(others)) for b in range(256)]


class PairTree:
    """Segment tree over the adjacent pairs of a piece.

    A leaf is rank << SHIFT | place, or NEVER and above for a pair that cannot merge; a node is the smaller of its two children, so
    the root names the lowest rank and, on a tie, the leftmost place. Levels are lists, leaves first.
    """

    def __init__(self, keys: list[int]):
        self.levels = [keys]
        while len(keys) > 1:
            if len(keys) & 1:
                keys.append(NEVER)
            keys = list(map(min, keys[::2], keys[1::2]))
            self.levels.append(keys)
        self.steps = list(zip(self.levels, self.levels[1:], strict=False))
        self.top = self.levels[-1]

    def root(self) -> int | None:
        """Place of the leftmost pair of lowest rank."""
        return self.top[0] & PLACE if self.top[0] < NEVER else None

    def put(self, place: int, key: int) -> None:
        """Change a leaf and the nodes above it, as far as they change."""
        self.levels[0][place] = key
        for below, above in self.steps:
            low, other = below[place], below[place ^ 1]
            if other < low:
                low = other
            place >>= 1
            if above[place] == low:
                return
            above[place] = low


def refuse(stated: dict) -> None:
    """Raise on whatever in a tokenizers file would change the tokens and is not done here."""
    model, before = stated["model"], stated.get("pre_tokenizer") or {}
    odd = {
        "normalizer": stated.get("normalizer"), "model": model.get("type", "BPE") != "BPE", "pre_tokenizer": before.get("type") != "ByteLevel", "add_prefix_space": before.get("add_prefix_space"),
        "use_regex": not before.get("use_regex", True), "added_tokens": any(t.get(k) for t in stated.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word")),
        **{k: model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback", "fuse_unk")},
    }
    if asked := sorted(k for k, v in odd.items() if v):
        raise ValueError(f"the vocabulary file asks for what is not supported: {', '.join(asked)}")


class Bpe:
    """Encoder and decoder of one vocabulary, as a tokenizers JSON file states it."""

    def __init__(self, content: str):
        stated = json.loads(content)
        refuse(stated)
        model, vocab = stated["model"], stated["model"]["vocab"]
        symbols = byte_symbols()
        self.byte_ids = [vocab.get(s) for s in symbols]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {vocab[a] << SHIFT | vocab[b]: rank << SHIFT for rank, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.first = [self.merges.get(a << SHIFT | b, NEVER) if a is not None and b is not None else NEVER for a in self.byte_ids for b in self.byte_ids]
        value = {s: b for b, s in enumerate(symbols)}
        self.bytes_of = {i: bytes(value[c] for c in token) if all(c in value for c in token) else token.encode() for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in stated.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pieces = regex.compile(PATTERN).findall
        self.memo: dict[str, tuple[str, int, bytes]] = {}
        self.held = 0

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ids = [self.byte_ids[b] for b in piece]
        if any(i is None for i in ids):
            raise ValueError("the vocabulary lacks a byte")
        n, key_of, made = len(ids), self.merges.get, self.made
        if n <= FLAT:
            return self.merge_flat(piece, ids)
        tree = PairTree([key_of(a << SHIFT | b, NEVER) | i for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))])
        top, put = tree.top, tree.put
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        while (low := top[0]) < NEVER:
            at = low & PLACE
            right = after[at]
            ids[at] = own = made[low >> SHIFT]
            ids[right] = -1
            after[at] = follow = after[right]
            if follow < n:
                ahead[follow] = at
                put(right, NEVER)
                put(at, key_of(own << SHIFT | ids[follow], NEVER) | at)
            else:
                put(at, NEVER)
            left = ahead[at]
            if left >= 0:
                put(left, key_of(ids[left] << SHIFT | own, NEVER) | left)
        return [i for i in ids if i >= 0]

    def merge_flat(self, piece: bytes, ids: list[int]) -> list[int]:
        """Ids of a short piece, from those of its bytes."""
        first, key_of, made = self.first, self.merges.get, self.made
        keys = [first[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
        while keys and (low := min(keys)) < NEVER:
            at = keys.index(low)
            ids[at] = own = made[low >> SHIFT]
            del ids[at + 1], keys[at]
            if at < len(keys):
                keys[at] = key_of(own << SHIFT | ids[at + 1], NEVER)
            if at:
                keys[at - 1] = key_of(ids[at - 1] << SHIFT | own, NEVER)
        return ids

    def segments(self, text: str) -> Iterator[str]:
        """Pieces of the text, special tokens among them."""
        if self.cut is None or not any(s in text for s in self.special):
            yield from self.pieces(text)
            return
        at = 0
        for hit in self.cut.finditer(text):
            yield from self.pieces(text[at : hit.start()])
            yield hit[0]
            at = hit.end()
        yield from self.pieces(text[at:])

    def piece_ids(self, piece: str) -> list[int]:
        return [self.special[piece]] if piece in self.special else self.merge(piece.encode("utf-8"))

    def encode(self, text: str | None) -> list[int]:
        return [i for piece in self.segments(text or "") for i in self.piece_ids(piece)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", errors="replace")

    def known(self, piece: str) -> tuple[str, int, bytes]:
        """(ids joined by commas, their number, the bytes they decode to) of a piece, remembered."""
        found = self.memo.get(piece)
        if found is None:
            if self.held >= MEMO_CHARS:
                self.memo.clear()
                self.held = 0
            ids = self.piece_ids(piece)
            found = (",".join(map(str, ids)), len(ids), b"".join(self.bytes_of[i] for i in ids))
            if len(piece) <= MEMO_PIECE:
                self.memo[piece] = found
                self.held += len(piece)
        return found

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """(n_tokens, sha256 of the ids, sha256 of the decoded text) of one text."""
        ids, count, raw = [], 0, []
        known, memo = self.known, self.memo
        for piece in self.segments(text or ""):
            a, n, b = memo.get(piece) or known(piece)
            ids.append(a)
            count += n
            raw.append(b)
        decoded = b"".join(raw).decode("utf-8", errors="replace").encode("utf-8")
        return count, hashlib.sha256(",".join(ids).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _content(spark: SparkSession, path: str | None):
    raw = Path(path or default_path()).read_bytes()
    if len(raw) > MOST_BYTES:
        raise ValueError(f"a vocabulary of {len(raw)} bytes is too large to broadcast")
    return spark.sparkContext.broadcast(raw.decode("utf-8"))


@lru_cache(maxsize=4)
def _built(content: str) -> Bpe:
    return Bpe(content)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array of int) added; ``path`` names a tokenizers JSON file."""
    arrow_batches(docs.sparkSession)
    docs, content = docs.drop("ids"), _content(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _built(content.value)
        for batch in batches:
            ids = pa.array([bpe.encode(text) for text in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "ids"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded`` (string) added from its ``ids``."""
    arrow_batches(encoded.sparkSession)
    encoded, content = encoded.drop("decoded"), _content(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _built(content.value)
        for batch in batches:
            texts = pa.array([bpe.decode(ids or []) for ids in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes each text without keeping ids."""
    arrow_batches(docs.sparkSession)
    content = _content(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _built(content.value)
        for batch in batches:
            n, ids, decoded = zip(*map(bpe.digest, batch.column("text").to_pylist()), strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the digests of each remaining document."""
    return digests(docs.select(*DOCUMENT))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"op4_bpe": op4_bpe}
ORACLE: dict[str, str] = {}
