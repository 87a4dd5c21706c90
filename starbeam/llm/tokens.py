"""Token counts: lengths only, from a public tokenizer's library.

Rows reach Python as Arrow batches, are dealt into batches of about
``batch_bytes`` of text, and come back as counts.  A text is cut where the
vocabulary cannot merge across: before a run of spaces and before a line
feed.  No piece holds a space mark behind another character, and the line
feed is in no piece but its own byte, so the sum over the segments equals the
count of the whole text; ``tests/llm`` compares both.  That bounds what the
library sees at a time, however long a text is, and lets a task encode each
different segment once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
BATCH_BYTES = 4 << 20
#: different segments a task remembers at most; the memory is emptied when it is full
MEMORY = 400_000
#: texts longer than this are cut on their way through the segmenter, at a safe boundary
STRETCH = 1 << 20

#: a line feed with what follows it, spaces with what follows them, or the text's first segment
SEGMENT = re.compile("\n[^ \n]*| +[^ \n]*|[^ \n]+")


def tokenizer_path(model: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(model)


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """A text in parts of about ``size`` characters that end where a segment ends."""
    at = 0
    while len(text) - at > size:
        cut = text.rfind("\n", at + 1, at + size)
        if cut < 0:
            cut = text.rfind(" ", at + 1, at + size)
            while cut > at and text[cut - 1] == " ":  # spaces belong to what follows
                cut -= 1
        if cut <= at:  # one segment longer than the stretch
            m = SEGMENT.match(text, at)
            cut = m.end()
        yield text[at:cut]
        at = cut
    yield text[at:]


class SegmentCounter:
    """Counts the tokens of whole texts, segment by segment."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], memory: int = MEMORY) -> None:
        self.encode, self.memory = encode, memory
        self.known: dict[str, int] = {}

    def learn(self, new: list[str]) -> None:
        # the library puts a space mark before what it is given: it stands for a segment's first
        # space, and before a line feed it is one token too many, as nothing merges with a line feed
        given = [s[1:] if s[0] == " " else s for s in new]
        for s, g, ids in zip(new, given, self.encode(given), strict=True):
            self.known[s] = 1 if not g else len(ids) - (s[0] == "\n")

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace("▁", " ")  # the library's own mark for a space
        total, begun = 0, False
        for part in stretches(text):
            segments = SEGMENT.findall(part)
            if not begun:
                begun = True
                if segments[0][0] in " \n":  # here the mark comes on top of the text's own first character
                    total += len(self.encode([segments[0]])[0])
                    segments = segments[1:]
            step = max(1, self.memory // 2)
            for i in range(0, len(segments), step):
                some = segments[i : i + step]
                new = set(some).difference(self.known)
                if new and len(self.known) + len(new) > self.memory:
                    self.known.clear()
                    new = set(some)
                self.learn(list(new))
                total += sum(map(self.known.__getitem__, some))
        return total


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = LIMIT, batch_bytes: int = BATCH_BYTES,
                 memory: int = MEMORY) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: no bytes, no tokens.  Equal rows get equal
    results, an empty table an empty result; other columns are not read.
    ``model`` is a sentencepiece file whose pieces hold no space mark behind
    another character; others are refused.
    """
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(model))
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError(f"{model}: a piece merges across a segment boundary")
        counter = SegmentCounter(lambda texts: sp.encode(texts, num_threads=1), memory)
        for batch in batches:
            for part in by_bytes(batch, batch_bytes):
                n = [counter.count(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def by_bytes(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each (one row at least)."""
    start, held = 0, 0
    for i, n in enumerate(batch.column("n_bytes").to_pylist()):
        if held and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)
