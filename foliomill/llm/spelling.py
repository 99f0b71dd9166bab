"""Spelling variants: a corpus vocabulary whose words one edit apart are linked and led to their most frequent form.

Two words one edit apart agree before and behind the edit. A word is therefore filed under what surrounds each stretch in
which the edit may lie, first the two halves of the word; a file with too many words is cut into those of half the
stretch, down to a single place, where the alphabet bounds it. Within a file only the stretches differ. They are scanned
as a sorted list: the rows of the edit matrix, three cells around the diagonal, are kept for the prefix that a word
shares with the one before, and when a row has no cell of one edit or less, all words that share its prefix are skipped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.components import stored
from foliomill.llm.sizes import BATCH_ROWS, small_batches

SLIP = 97  # of the hashes, those divisible by it lose a letter
SHORTEST = 5
RAREST = 3
FILE_WORDS = 1024  # words above which a file is cut
HELD_WORDS = 200_000  # different words that a task counts before it passes them on
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FILE = ("m", "a", "b", "before", "behind")


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n`` over all texts: runs of letters in lower case, of which one in ``SLIP`` loses a letter by its hash."""
    run = re.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)
    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.coalesce(F.col(text_column), F.lit("")))

    def emit(total: Counter) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
        total.clear()
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for part in small_batches(batch, BATCH_ROWS):
                ids, texts = part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()
                for doc, text in zip(ids, texts, strict=True):
                    start = zlib.crc32(f"{doc}:".encode())
                    for word, n in Counter(run.findall(text.translate(_LOWER).decode("utf-8", "replace"))).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % SLIP == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < SHORTEST:
                                continue
                        total[word] += n
                    if len(total) > HELD_WORDS:
                        yield emit(total)
        yield emit(total)

    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def one_edit_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """Positions ``i < j`` of the words of a sorted list that are exactly one edit apart.

    ``row`` has the distances of a prefix of the scanned word to the prefixes of the query that are one shorter, as long
    and one longer. ``shared[j]`` is the prefix that word ``j`` shares with the one before, ``after[j]`` the next word that
    shares less.
    """
    n = len(words)
    shared = [0] * n
    for j in range(1, n):
        a, b = words[j - 1], words[j]
        k, most = 0, min(len(a), len(b))
        while k < most and a[k] == b[k]:
            k += 1
        shared[j] = k
    after, open_ = [n] * n, []
    for j in range(n):
        while open_ and shared[open_[-1]] > shared[j]:
            after[open_.pop()] = j
        open_.append(j)
    for i, query in enumerate(words):
        long = len(query)
        padded = query + "\0\0\0"
        rows = [(2, 0, 1)]
        j, keep = i + 1, 0
        while j < n:
            word = words[j]
            depth = min(keep, len(rows) - 1)
            del rows[depth + 1 :]
            short, same, longer = rows[depth]
            dead = 0
            while depth < len(word):
                c = word[depth]
                shorter = min(same + 1, short + (depth == 0 or padded[depth - 1] != c))
                level = min(same + (padded[depth] != c), longer + 1, shorter + 1) if depth < long else 2
                ahead = min(longer + (padded[depth + 1] != c), level + 1) if depth + 1 < long else 2
                depth += 1
                if depth - 1 > long:
                    shorter = 2
                short, same, longer = shorter, level, ahead
                rows.append((short, same, longer))
                if short > 1 and same > 1 and longer > 1:
                    dead = depth
                    break
            if not dead:
                gap = long - len(word)
                if -1 <= gap <= 1 and rows[-1][gap + 1] == 1:
                    yield i, j
            j += 1
            if dead:
                while j < n and shared[j] >= dead:
                    j = after[j] if shared[j] > dead else j + 1
            # what all words since the last scanned one share with it
            keep = shared[j] if j < n else 0


def _filed(words: DataFrame) -> DataFrame:
    """Words under the first stretches: as the shorter word of a pair, and as the longer one."""
    long = F.length("word")
    ends = F.filter(F.array(long, long - 1), lambda m: m >= SHORTEST)
    placed = words.select("word", "n", F.explode(ends).alias("m"), F.lit(0).alias("a")).withColumn("b", F.col("m"))
    return _halved(placed)


def _halved(filed: DataFrame) -> DataFrame:
    """Each word under the two halves of its stretch."""
    mid = F.ceil((F.col("a") + F.col("b")) / 2).cast("int")
    halves = F.array(F.struct(F.col("a").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b").alias("b")))
    cut = filed.select("word", "n", "m", F.explode(halves).alias("_h")).select("word", "n", "m", "_h.a", "_h.b")
    return cut.withColumns(
        {"before": F.expr("substring(word, 1, a)"), "behind": F.expr("right(word, m - b)")}
    )


def _bounded_files(words: DataFrame) -> DataFrame:
    """Words under stretches of files with at least two and, unless a stretch is a single place, ``FILE_WORDS`` words."""
    filed, done = stored(_filed(words), "filed"), []
    while True:
        sizes = filed.groupBy(*_FILE).agg(F.count("*").alias("_size")).filter("_size > 1")
        sized = stored(filed.join(sizes, list(_FILE)), "sized")
        large = (F.col("_size") > FILE_WORDS) & (F.col("b") - F.col("a") > 1)
        done.append(sized.filter(~large).drop("_size"))
        rest = sized.filter(large)
        if rest.isEmpty():
            break
        filed = stored(_halved(rest), "filed")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n`` for both directions of every pair of ``words`` (``word, n``) that is one edit apart, once each."""
    middle = F.expr("substring(word, a + 1, length(word) - a - (m - b))")
    files = _bounded_files(words).withColumn("middle", middle)
    files = files.repartition(*_FILE).sortWithinPartitions(*_FILE, "middle").select(*_FILE, "middle", "word", "n")

    def pairs(file: tuple, middles: list[str], own: list[str], n: list[int]) -> Iterator[tuple[str, str, int]]:
        m, a, b = file[:3]
        for i, j in one_edit_pairs(middles):
            x, y = middles[i], middles[j]
            if len(x) == len(y) == b - a + 1:
                continue  # filed as pairs of the next length
            at, most = 0, min(len(x), len(y))
            while at < most and x[at] == y[at]:
                at += 1
            if at < b - a or b == m:  # else the first difference lies in the file of the next stretch
                yield own[i], own[j], n[j]
                yield own[j], own[i], n[i]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held, found = None, ([], [], []), []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *key, middle, word, n in zip(*columns, strict=True):
                if key != file:
                    if len(held[0]) > 1:
                        found.extend(pairs(file, *held))
                    file, held = key, ([], [], [])
                for values, value in zip(held, (middle, word, n), strict=True):
                    values.append(value)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["word", "near", "near_n"])
                found = []
        if len(held[0]) > 1:
            found.extend(pairs(file, *held))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["word", "near", "near_n"])

    return files.mapInArrow(scan, "word string, near string, near_n bigint")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: each round doubles the steps that a word has been led along.

    A form is at least twice as frequent as its word, so chains end and are short.
    """
    led = stored(forms.select("word", F.col("form").alias("root")), "led")
    while True:
        ahead = led.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        led = stored(led.join(ahead, "root", "left"), "led")
        more = not led.filter("_next IS NOT NULL").isEmpty()
        led = led.select("word", F.coalesce("_next", "root").alias("root"))
        if not more:
            return led


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rarest: int = RAREST
) -> DataFrame:
    """One row per word of at least ``SHORTEST`` code points and ``rarest`` occurrences: ``word, form, root, n, n_near, form_n``.

    ``n_near`` counts the words exactly one inserted, deleted or replaced code point away; ``form`` is the most frequent
    of them (ties: the smallest in code-point order) if it is at least twice as frequent as the word, else null; ``root``
    is where the forms lead. Null and empty texts have no words; a null id counts as empty text in the hash; repeated
    rows count as often as they occur; an empty table gives an empty result; other columns are not read.
    """
    words = stored(word_counts(docs, id_column, text_column).filter(F.col("n") >= rarest), "words")
    # of largest n, then smallest word: the least of (-n, word)
    best = F.min(F.struct((-F.col("near_n")).alias("_minus"), F.col("near").alias("_near")))
    linked = stored(near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_best")), "near-words")
    found = words.join(linked, "word", "left")
    good = -F.col("_best._minus") >= 2 * F.col("n")
    found = stored(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(good, F.col("_best._near")).alias("form"),
            F.when(good, -F.col("_best._minus")).alias("form_n"),
        ),
        "formed",
    )
    roots = _roots(found.filter("form IS NOT NULL"))
    found = found.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
