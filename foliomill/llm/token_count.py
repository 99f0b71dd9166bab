"""Token counts of a byte-pair vocabulary: a heap of adjacent pairs over a linked list, without producing ids."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.sizes import BATCH_ROWS, small_batches

SPACE = "▁"  # fixed value: stands for a blank in the pieces
CACHE_WORDS = 1_000_000


class PieceMerger:
    """Counts the pieces of a text from the ranks of a vocabulary's pieces."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks
        self.single = {c for piece in ranks for c in piece}
        inner = [p for p in ranks if SPACE in p.lstrip(SPACE)]
        if inner:
            raise ValueError(f"pieces with a blank after other characters are not supported: {inner[:3]}")
        # blanks only open a piece, and a character in no longer piece never merges: texts may be cut there
        joined = {c for piece in ranks if len(piece) > 1 for c in piece}
        alone = "".join(re.escape(c) for c in "\n\t" if c not in joined)
        self.units = re.compile(f" *[^ {alone}]+|[{alone}]| +" if alone else " *[^ ]+| +")

    @classmethod
    @lru_cache(maxsize=2)
    def load(cls, model_file: str) -> PieceMerger:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        return cls({model.id_to_piece(i): -model.get_score(i) for i in plain})

    def count_unit(self, unit: str) -> int:
        """Symbols minus merges; the pair of lowest rank goes first, of equal ranks the leftmost."""
        ranks = self.ranks
        symbols = list(unit.replace(" ", SPACE))
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in ranks]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not symbols[i] or j >= n or symbols[i] + symbols[j] != pair:
                continue  # one side has been merged since
            merges += 1
            symbols[i], symbols[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := pair + symbols[k]) in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            h = before[i]
            if h >= 0 and (p := symbols[h] + pair) in ranks:
                heapq.heappush(heap, (ranks[p], h, p))
        # a character outside the vocabulary falls back to its bytes
        extra = sum(len(c.encode()) - 1 for c in unit if c not in ranks and c != " ")
        return n - merges + extra


class _Counts(dict):
    """Counts of the units met so far by this worker process."""

    def __init__(self, merger: PieceMerger):
        super().__init__()
        self.merger = merger

    def __missing__(self, unit: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self.merger.count_unit(unit)
        if len(unit) <= 64:
            self[unit] = found
        return found


@lru_cache(maxsize=2)
def _counts(model_file: str) -> _Counts:
    return _Counts(PieceMerger.load(model_file))


def text_units(counts: _Counts, text: str) -> list[str]:
    """Units that no piece can cross; a text's own stand-in for a blank is a blank to the library."""
    return counts.merger.units.findall(" " + text.replace(SPACE, " ")) if text else []


def token_counts(
    docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 4096
) -> DataFrame:
    """One row per input row: ``<id_column>, n_bytes, n_tokens, over_limit``.

    Counts the pieces that a byte-pair piece model with byte fallback gives for the whole text, without begin or end.
    The heap works on units that no piece can cross; a worker keeps the counts of up to ``CACHE_WORDS`` units.
    Null and empty texts have 0 bytes and 0 tokens. Ids are passed on as they are, null and repeated ones too; other
    columns are not read; an empty table gives an empty result. ``model_file`` must exist on every worker.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(model_file)
        for batch in batches:
            for part in small_batches(batch, BATCH_ROWS):
                n_bytes, n_tokens = [], []
                for text in part.column(1).to_pylist():
                    n_bytes.append(len(text.encode()))
                    n_tokens.append(sum(map(counts.__getitem__, text_units(counts, text))))
                yield pa.record_batch([part.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], names=["_id", "n_bytes", "n_tokens"])

    found = rows.mapInArrow(count, f"_id {id_type}, n_bytes bigint, n_tokens bigint")
    return found.select(
        F.col("_id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
