"""Byte-level byte-pair encoding over a trie of distinct words, and decoding.

The encoding of a word is given by the last token of each of its prefixes: a token that ends at a prefix is its last one
exactly if the tokens before it end in a token with which it stands unmerged. That state depends on the prefix alone, so
it is computed once per node of the trie of all words.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.sizes import BATCH_ROWS, small_batches

# fixed value: the split pattern of this family of vocabularies
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CACHE_WORDS = 600_000
LONG_WORD = 256  # longer words are encoded, but not kept


def byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in vocabulary files: printable ones for themselves, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Vocabulary, and the encodings of the words met so far by this process."""

    def __init__(self, vocabulary_file: str):
        with open(vocabulary_file, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        plain = lambda token: bytes(letters[c] for c in token)
        self.ids = {plain(t): i for t, i in spec["model"]["vocab"].items()}
        self.longest = max(map(len, self.ids))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: t for t, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.made_from: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank of the merge
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (plain(p) for p in (pair.split(" ") if isinstance(pair, str) else pair))
            a, b, made = self.ids[left], self.ids[right], self.ids[left + right]
            self.merge_rank[a, b] = rank
            self.made_from.setdefault(made, (a, b, rank))
        self.stands: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

    def stand_apart(self, left: int, right: int) -> bool:
        """Whether two tokens next to each other stay unmerged.

        The merges that made the two are undone from the latest to the earliest; at each step the tokens at the seam may
        have no merge that would have come before those still to be done.
        """
        pair = (left, right)
        found = self.stands.get(pair)
        if found is not None:
            return found
        limit, found = len(self.merge_rank), True
        while True:
            # a merge at the seam comes first if its rank is lower than that of the next merge of the real encoding
            rank = self.merge_rank.get((left, right))
            if rank is not None and rank < limit:
                found = False
                break
            from_left, from_right = self.made_from.get(left), self.made_from.get(right)
            if from_left is None and from_right is None:
                break
            if from_right is None or (from_left is not None and from_left[2] > from_right[2]):
                left, limit = from_left[1], from_left[2]
            else:
                # the left token's own merge of equal or lower rank has happened before: a seam merge of that very rank loses to it
                right, limit = from_right[0], from_right[2] + 1
        if len(self.stands) >= 4_000_000:
            self.stands.clear()
        self.stands[pair] = found
        return found

    def learn(self, words: Iterable[str]) -> None:
        """Encode distinct words depth-first over their trie; in sorted order each node is entered once."""
        ids, longest, stands, apart = self.ids, self.longest, self.stands, self.stand_apart
        last: list[int] = [-1]  # last token of each prefix on the path
        size: list[int] = [0]  # its length
        path = b""
        for raw, word in sorted((w.encode(), w) for w in words):
            shared, top = 0, min(len(path), len(raw))
            while shared < top and path[shared] == raw[shared]:
                shared += 1
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                for start in range(max(0, end - longest), end):
                    token = ids.get(raw[start:end])
                    if token is None:
                        continue
                    if start == 0:
                        break
                    pair = (last[start], token)
                    ok = stands.get(pair)
                    if ok or (ok is None and apart(*pair)):
                        break
                last.append(token)
                size.append(end - start)
            path, out, end = raw, [], len(raw)
            while end:
                out.append(last[end])
                end -= size[end]
            self.known[word] = struct.pack(f"<{len(out)}I", *reversed(out))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut: list[list[list[str] | bytes]] = []
        for text in texts:
            parts = self.cut.split(text) if self.cut else [text]
            cut.append([struct.pack("<I", self.special[p]) if p in self.special else WORDS.findall(p) for p in parts if p])
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        fresh: set[str] = set().union(*(p for parts in cut for p in parts if isinstance(p, list)))
        fresh.difference_update(self.known)
        self.learn(fresh)
        known = self.known
        out = [b"".join(p if isinstance(p, bytes) else b"".join(map(known.__getitem__, p)) for p in parts) for parts in cut]
        for word in fresh:
            if len(word) > LONG_WORD:
                del known[word]
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _coder(vocabulary_file: str) -> ByteBpe:
    return ByteBpe(vocabulary_file)


def encode_texts(docs: DataFrame, vocabulary_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``<id_column>, token_ids, decoded``.

    ``token_ids`` is binary, little-endian unsigned 32-bit integers; ``decoded`` is the text decoded from them. Null and
    empty texts give no ids and an empty text. Special tokens are recognised inside texts and none are added. Ids are
    passed on as they are, null and repeated ones too; other columns are not read; an empty table gives an empty result.
    ``vocabulary_file`` must exist on every worker.
    """
    return _mapped(docs, vocabulary_file, id_column, text_column, digests=False)


def encoded_digests(docs: DataFrame, vocabulary_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """As ``encode_texts``, but ``<id_column>, n_tokens, ids_sha256, decoded_sha256`` without carrying ids and texts out."""
    return _mapped(docs, vocabulary_file, id_column, text_column, digests=True)


def _mapped(docs: DataFrame, vocabulary_file: str, id_column: str, text_column: str, digests: bool) -> DataFrame:
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    hashed = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary_file)
        for batch in batches:
            for part in small_batches(batch, BATCH_ROWS):
                ids = coder.encode_many(part.column(1).to_pylist())
                texts = map(coder.decode, ids)
                if digests:
                    columns = [
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(list(map(hashed, ids)), pa.string()),
                        pa.array([hashed(t.encode()) for t in texts], pa.string()),
                    ]
                    yield pa.record_batch([part.column(0), *columns], names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    columns = [pa.array(ids, pa.binary()), pa.array(list(texts), pa.string())]
                    yield pa.record_batch([part.column(0), *columns], names=["_id", "token_ids", "decoded"])

    made = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "token_ids binary, decoded string"
    return rows.mapInArrow(run, f"_id {id_type}, {made}").withColumnRenamed("_id", id_column)
