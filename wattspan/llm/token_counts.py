"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton lists the vocabulary's matches in a text; dynamic programming
over their ends carries the best score and its number of pieces only. Ties follow the
tokenizer: of equal scores the match that starts first stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.llm.common import table
from wattspan.llm.tokens import Known

SPACE = "▁"
# The tokenizer's penalty below its lowest score for a character without a piece.
UNKNOWN_PENALTY = 10.0
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]


class UnigramCounter:
    """Number of pieces of the best segmentation of a text.

    Spaces become the space mark, one of which is put in front. A character without a
    piece costs ``UNKNOWN_PENALTY`` below the lowest score, and counts its UTF-8 bytes
    where all byte pieces exist (as the tokenizer's byte fallback), else runs of such
    characters count one.

    No piece of the vocabulary holds the mark after another character, so every
    segmentation has a boundary before each run of marks and the counts of such units add
    up; otherwise the text is one unit. Counts of units are remembered up to ``limit``.
    """

    def __init__(self, pieces: Sequence[tuple[str, float]], limit: int = 500_000) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.lowest = min((s for _, s in pieces), default=0.0)
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        names = {p for p, _ in pieces}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.separable = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in names)
        self.units = Known(self._count, limit)

    def _count(self, unit: str) -> int:
        """Forward pass; ``count`` leaves out unknown characters at first."""
        size = len(unit)
        best = [None] * (size + 1)
        best[0] = (0.0, 0, False)
        unknown = self.lowest - UNKNOWN_PENALTY
        matches: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
        single = [False] * size
        for last, (length, score) in self.automaton.iter(unit):
            matches[last + 1].append((last + 1 - length, score))
            if length == 1:
                single[last] = True
        for end in range(1, size + 1):
            chosen = None
            # The automaton lists the longest match of an end, so the first start, first.
            for start, score in matches[end]:
                before = best[start]
                total = before[0] + score
                if chosen is None or total > chosen[0]:
                    chosen = (total, before[1] + 1, False)
            if not single[end - 1]:
                before = best[end - 1]
                total = before[0] + unknown
                if chosen is None or total > chosen[0]:
                    pieces = len(unit[end - 1].encode("utf-8", "surrogatepass"))
                    if not self.bytes:
                        pieces = 0 if before[2] else 1
                    chosen = (total, before[1] + pieces, True)
            best[end] = chosen
        return best[size][1]

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.separable or not self.bytes:
            return self._count(marked)
        return sum(map(self.units.__getitem__, UNIT.findall(marked)))


_COUNTERS: dict[str, UnigramCounter] = {}


def counter(model_file: str) -> UnigramCounter:
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = UnigramCounter(vocabulary(model_file))
    return _COUNTERS[model_file]


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row of ``docs``, by its whole ``text``.

    A null or empty text has no tokens; repeated rows and rows without an id stay; other
    columns are ignored.
    """

    def count(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = counter(model_file)
        for batch in batch_iter:
            counts = [number(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"]
            )

    chosen = docs.select(F.col("doc_id").cast("long"), "text")
    return chosen.mapInArrow(count, "doc_id long, n_tokens long")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all ``documents`` under the 32k vocabulary taken as a unigram model."""
    import public_tokenizers

    return token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
