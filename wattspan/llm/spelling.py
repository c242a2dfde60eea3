"""Spelling variants: words that differ by one letter, found over a reduced alphabet.

Letters are hashed to a few symbols. Of every reduced word the full one-edit neighbourhood is
generated and joined with the reduced vocabulary; words that meet are compared letter by letter.
A reduced word is filed twice, with its exact first and with its exact last half: an edit leaves
one of them as it was, so the neighbourhood is filed with that one, and few words meet in vain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.llm.common import BASE, LOWER, UPPER, mix64, stage, table

RUN = r"([A-Za-zÀ-ÿ]+)"
SYMBOLS = 3
SHORTEST, LEAST = 5, 3
DROP_ONE_IN = 97
# A form has at least so many times the occurrences of its variant.
FORM_FACTOR = 2
# Vocabulary rows under one key from which on they are dealt out to several tasks.
SPLIT_FROM = 4096
# Numbers generated, and pairs compared, at once.
AT_ONCE = 1 << 20
PAIRS_AT_ONCE = 1 << 17

KEY_SCHEMA = "key LONG, word STRING, n LONG"
NEAR_SCHEMA = "word STRING, n_near LONG, minus_n LONG, form STRING"
FIRST, LAST = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)


def word_counts(docs: DataFrame, drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """``word`` and ``n`` of all lower-cased runs of letters.

    One run in ``drop_one_in``, by a hash of document and run, loses one letter. A null id is
    an empty text in that hash; a null text has no runs.
    """
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), 1)
    # Exploded before anything else is made of it, so that a run is extracted once.
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    hashed = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod("h", F.length("run")).cast("int")
    dropped = F.concat(F.substring("run", 1, at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % drop_one_in == 0, dropped).otherwise(F.col("run"))
    words = each.withColumn("h", hashed).select(word.alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def letters(words: list[str], size: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.array(words, f"<U{size}").view(np.uint32).reshape(len(words), size)


def _hashes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Polynomial hashes of all beginnings and all endings, and the powers of the base."""
    count, size = symbols.shape
    power = np.full(size + 2, BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    before = np.zeros((count, size + 1), np.uint64)
    after = np.zeros((count, size + 1), np.uint64)
    for k in range(size):
        before[:, k + 1] = before[:, k] * np.uint64(BASE) + symbols[:, k]
    for k in range(size - 1, -1, -1):
        after[:, k] = after[:, k + 1] + symbols[:, k] * power[size - 1 - k]
    return before, after, power


class Filing:
    """Keys of the words of one length."""

    def __init__(self, words: list[str], size: int, symbols: int) -> None:
        exact = letters(words, size).astype(np.uint64)
        reduced = mix64(exact) % np.uint64(symbols) + np.uint64(1)
        self.size, self.symbols = size, symbols
        self.before, self.after, self.power = _hashes(reduced)
        self.exact_before, self.exact_after, _ = _hashes(exact)

    def _key(self, reduced: np.ndarray, last: bool, target: int) -> np.ndarray:
        """Key of a reduced word of ``target`` letters with one exact half of its."""
        half = target // 2
        exact = self.exact_after[:, self.size - half] if last else self.exact_before[:, half]
        side = mix64(exact * np.uint64(BASE) + np.uint64(target)) ^ (LAST if last else FIRST)
        return mix64(reduced ^ side[:, None])

    def own(self) -> np.ndarray:
        """The two keys of every word itself."""
        whole = self.before[:, -1:]
        return np.concatenate([self._key(whole, last, self.size) for last in (True, False)], axis=1)

    def neighbours(self) -> np.ndarray:
        """Keys of all reduced words at most one edit away, a row per word; some repeat."""
        size, keys = self.size, [self.own()]
        before, after, power = self.before, self.after, self.power
        symbol = np.arange(1, self.symbols + 1, dtype=np.uint64)

        def add(target: int, made, positions: np.ndarray, keeps_end: np.ndarray) -> None:
            for last in (True, False):
                at = positions[keeps_end == last]
                if len(at):
                    keys.append(self._key(made(at).reshape(len(before), -1), last, target))

        at = np.arange(size)

        def replaced(i: np.ndarray) -> np.ndarray:
            around = before[:, i] * power[size - i] + after[:, i + 1]
            return around[:, :, None] + symbol * power[size - 1 - i][:, None]

        def deleted(i: np.ndarray) -> np.ndarray:
            return before[:, i] * power[size - 1 - i] + after[:, i + 1]

        def inserted(i: np.ndarray) -> np.ndarray:
            around = before[:, i] * power[size + 1 - i] + after[:, i]
            return around[:, :, None] + symbol * power[size - i][:, None]

        add(size, replaced, at, at < size - size // 2)
        if size > 1:
            add(size - 1, deleted, at, at < size - (size - 1) // 2)
        at = np.arange(size + 1)
        add(size + 1, inserted, at, at <= size - (size + 1) // 2)
        return np.concatenate(keys, axis=1)


def filed(vocabulary: DataFrame, symbols: int, neighbours: bool) -> DataFrame:
    """Words under their own two keys, or, without ``n``, under those of their neighbourhood."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, counts = batch.column("word"), batch.column("n")
            words = np.array(column.to_pylist(), object)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                step = max(1, AT_ONCE // ((2 * symbols + 1) * (size + 1)) if neighbours else AT_ONCE // size)
                for low in range(0, len(rows), step):
                    part = rows[low : low + step]
                    filing = Filing(words[part].tolist(), size, symbols)
                    if neighbours:
                        keys = np.sort(filing.neighbours(), axis=1)
                        fresh = np.ones(keys.shape, bool)
                        fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
                        at = np.repeat(part, fresh.sum(axis=1))
                        keys, n = keys[fresh], pa.nulls(len(at), pa.int64())
                    else:
                        keys, at = filing.own().ravel(), np.repeat(part, 2)
                        n = counts.take(pa.array(at))
                    own = pa.array(keys.view(np.int64))
                    yield pa.record_batch([own, column.take(pa.array(at)), n], ["key", "word", "n"])

    return vocabulary.mapInArrow(file, KEY_SCHEMA)


def near(asked: list[str], known: list[str]) -> np.ndarray:
    """Which pairs differ by one inserted, deleted or replaced letter, counted once.

    A pair is filed under its last half where both words end in it, else under the first half
    only; the second array tells which: whether both end in the last half of the known word.
    """
    count = len(asked)
    a_size = np.fromiter(map(len, asked), np.int64, count)
    b_size = np.fromiter(map(len, known), np.int64, count)
    good, ends = np.zeros(count, bool), np.zeros(count, bool)
    longest = np.maximum(a_size, b_size)
    # Pairs of like length together, so that a long word does not widen all rows.
    for level in np.unique(np.ceil(np.log2(longest + 1))):
        rows = np.flatnonzero(np.ceil(np.log2(longest + 1)) == level)
        width = int(longest[rows].max())
        step = max(1, AT_ONCE * 2 // width)
        for low in range(0, len(rows), step):
            part = rows[low : low + step]
            a, b = letters([asked[i] for i in part], width), letters([known[i] for i in part], width)
            n, m = a_size[part], b_size[part]
            column = np.arange(width)
            differs = (a != b) | (column >= np.minimum(n, m)[:, None])
            start = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
            from_end = np.arange(1, width + 1)
            left, right = n[:, None] - from_end, m[:, None] - from_end
            row = np.arange(len(part))[:, None]
            differs = (left < 0) | (right < 0) | (a[row, np.maximum(left, 0)] != b[row, np.maximum(right, 0)])
            end = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
            small, large = np.minimum(n, m), np.maximum(n, m)
            one = np.where(n == m, start + end == n - 1, (large - small == 1) & (start + end >= small))
            good[part] = one & ~((n == m) & (start >= n))
            ends[part] = end >= m // 2
    return np.stack([good, ends])


def last_keys(words: list[str], keys: np.ndarray, symbols: int) -> np.ndarray:
    """Whether each key is that of its word with the last half."""
    out = np.zeros(len(words), bool)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        out[rows] = Filing([words[i] for i in rows], size, symbols).own()[:, 0] == keys[rows]
    return out


def _groups(rows: pa.Table) -> np.ndarray:
    """Numbers of the groups, a key and a part of it each, of rows in order of both."""
    key, part = (rows.column(name).to_numpy() for name in ("key", "part"))
    return np.cumsum(np.concatenate([[False], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))


def _pairs(rows: pa.Table, symbols: int) -> Iterator[pa.RecordBatch]:
    """Near words of the words asked for in ``rows``, which hold whole groups in order."""
    keys, group = rows.column("key").to_numpy(), _groups(rows)
    n = rows.column("n").combine_chunks()
    is_known = n.is_valid().to_numpy(zero_copy_only=False)
    known_at, asked_at = np.flatnonzero(is_known), np.flatnonzero(~is_known)
    low = np.searchsorted(group[known_at], group[asked_at], "left")
    times = np.searchsorted(group[known_at], group[asked_at], "right") - low
    asked_at, low, times = asked_at[times > 0], low[times > 0], times[times > 0]
    if not len(asked_at):
        return
    words = rows.column("word")
    known = np.array(words.take(pa.array(known_at)).to_pylist(), object)
    asked = np.array(words.take(pa.array(asked_at)).to_pylist(), object)
    weight = n.take(pa.array(known_at)).to_numpy()
    by_last = last_keys(known.tolist(), keys[known_at].view(np.uint64), symbols)
    # In parts of bounded numbers of pairs; one word may meet more than that.
    total = np.cumsum(times)
    first = 0
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while first < int(total[-1]):
        beyond = min(first + PAIRS_AT_ONCE, int(total[-1]))
        number = np.arange(first, beyond)
        who = np.searchsorted(total, number, "right")
        whom = low[who] + number - (total[who] - times[who])
        good, ends = near(asked[who].tolist(), known[whom].tolist())
        good &= ends == by_last[whom]
        found.append((who[good], whom[good]))
        first = beyond
    who, whom = (np.concatenate(part) for part in zip(*found))
    if not len(who):
        return
    # One row per asked word: number of near words, and the best of them.
    names, of = np.unique(asked[who].astype(str), return_inverse=True)
    best = np.lexsort((known[whom].astype(str), -weight[whom], of))
    heads = best[np.concatenate([[True], of[best][1:] != of[best][:-1]])]
    columns = [pa.array(names.tolist(), pa.string()), pa.array(np.bincount(of).astype(np.int64))]
    columns += [pa.array(-weight[whom[heads]]), pa.array(known[whom[heads]].tolist(), pa.string())]
    yield pa.record_batch(columns, ["word", "n_near", "minus_n", "form"])


def near_words(
    vocabulary: DataFrame, symbols: int = SYMBOLS, split_from: int = SPLIT_FROM, at_once: int = AT_ONCE
) -> DataFrame:
    """For words with any: their number of near words, and the most frequent one with its ``n``.

    ``vocabulary`` has distinct, non-empty ``word`` with ``n``. Of equally frequent near words
    the first in code-point order is given.
    """
    known, asked = filed(vocabulary, symbols, False), filed(vocabulary, symbols, True)
    counts = known.groupBy("key").agg(F.count("*").alias("times")).where(F.col("times") > split_from)
    hot = stage(counts.select("key", F.ceil(F.col("times") / split_from).cast("int").alias("parts")), "spelling-hot")
    own = F.coalesce("parts", F.lit(1))
    known = known.join(hot, "key", "left").withColumn("part", F.pmod(F.xxhash64("word"), own).cast("int"))
    every = F.explode(F.sequence(F.lit(0), own - 1))
    asked = asked.join(hot, "key", "left").withColumn("part", every)
    both = known.unionByName(asked).drop("parts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < at_once:
                continue
            rows = pa.Table.from_batches(held)
            group = _groups(rows)
            edge = int(np.searchsorted(group, group[-1], "left"))
            if edge:
                yield from _pairs(rows.slice(0, edge), symbols)
                held = rows.slice(edge).combine_chunks().to_batches()
                size = sum(b.num_rows for b in held)
        if held:
            yield from _pairs(pa.Table.from_batches(held), symbols)

    dealt = both.repartition("key", "part").sortWithinPartitions("key", "part")
    partial = dealt.mapInArrow(compare, NEAR_SCHEMA)
    best = F.min(F.struct("minus_n", "form"))
    total = partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return total.select("word", "n_near", (-F.col("best.minus_n")).alias("near_n"), F.col("best.form").alias("nearest"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last of the forms that follow from ``form``.

    Every round doubles the number of forms followed; a form is at least twice as frequent as
    its variant, so there are few.
    """
    current = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = current.join(onward, "root", "left")
        after = stage(
            moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")),
            "spelling-roots",
        )
        current = after.drop("more")
        if after.where("more").isEmpty():
            return current


def spelling_variants(docs: DataFrame, symbols: int = SYMBOLS, split_from: int = SPLIT_FROM) -> DataFrame:
    """Words of at least five letters and three occurrences, with their forms and roots.

    See :func:`word_counts` for the words; only ``doc_id`` and ``text`` are read, repeated rows
    count again. A word without near words, or none at least twice as frequent, has no form and
    is its own root.
    """
    counts = word_counts(docs).where((F.length("word") >= SHORTEST) & (F.col("n") >= LEAST))
    vocabulary = stage(counts, "spelling-words")
    found = vocabulary.join(near_words(vocabulary, symbols, split_from), "word", "left")
    enough = F.col("near_n") >= FORM_FACTOR * F.col("n")
    formed = stage(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("nearest")).alias("form"),
            F.when(enough, F.col("near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    rooted = formed.join(roots(formed.where("form IS NOT NULL")), "word", "left")
    return rooted.withColumn("root", F.coalesce("root", "word"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with their near words, form and root."""
    found = spelling_variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
